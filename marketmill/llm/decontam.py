"""Benchmark decontamination by spaced-seed hashing.

Fixed masks of SPAN positions keep some token positions and ignore others, so
a pair of passages that differ in a few tokens still shares a masked hash.
Hashes of the documents are looked up among those of the test items; around
each hit the passage is compared token by token in both directions on the
hit's diagonal, and the best run of matches, less a penalty for every
substitution, is the overlap. A document is contaminated by an item where the
overlap has ENOUGH matching tokens, or MIN_MATCHES of them and MIN_SHARE of
the item's tokens. Items of fewer than SHORT words, of which MIN_MATCHES would
be more than the share, are also compared whole: one substitution in every
WINDOW words is allowed, anywhere. Of the item's windows of WINDOW words one
then has a single substitution at most, so masks that ignore one position find
every such place. Items of fewer than MIN_ITEM words say too little and match
nothing.

The test items are the smaller, given side. They go to the tasks in blocks of
at most BLOCK_TOKENS tokens (the size of a broadcast is bounded by that); each
block meets all documents, which are read once per block and never shuffled.

Words are compared after lower-casing A-Z and dropping ASCII punctuation at
their ends. Defined cases: null or empty texts of documents or items match
nothing; very long texts are compared whole; rows that repeat give rows that
repeat; no items or no documents give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketmill.llm.shared import lean, prepare, without_ids
from marketmill.llm.text import chunks, constants, mix, word_bounds, word_hashes

#: Kept positions of each mask; the others are ignored. No two substitutions nearby defeat all of them.
MASKS = ("111111111111", "110110110110", "101101101101", "111000111000", "000111000111", "110011001100")
SPAN = 12
MIN_MATCHES = 12
MIN_SHARE = 0.5
ENOUGH = 13
MIN_ITEM = 5
#: Words of a window of short items, in which one may be substituted, and its masks.
WINDOW = 5
SHORT_MASKS = ("01111", "10111", "11011", "11101", "11110")
SHORT = int(MIN_MATCHES / MIN_SHARE)
PENALTY = 2
BLOCK_TOKENS = 1_000_000

_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = True


def trimmed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts in lower case as one array, start and end of their words as they are compared, and for each text the range of its words."""
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    data = np.frombuffer((b"\n".join(texts) + b"\n").lower(), np.uint8)
    starts, ends = (x.copy() for x in word_bounds(data))
    while len(move := np.flatnonzero((starts < ends) & _PUNCTUATION[data[np.minimum(starts, len(data) - 1)]])):
        starts[move] += 1
    while len(move := np.flatnonzero((starts < ends) & _PUNCTUATION[data[ends - 1]])):
        ends[move] -= 1
    filled = starts < ends
    starts, ends = starts[filled], ends[filled]
    return data, starts, ends, np.searchsorted(starts, offsets)


def compared_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of the texts as they are compared, and for each text the range of its words."""
    data, starts, ends, bounds = trimmed_words(texts)
    return word_hashes(data, starts, ends), bounds


def masked_hashes(words: np.ndarray, mask: str, seed: int) -> np.ndarray:
    """The hash at each start of a mask's span of words, over the kept positions."""
    m = len(words) - len(mask) + 1
    if m < 1:
        return np.empty(0, np.uint64)
    total = np.full(m, np.uint64(seed))
    for k, c in enumerate(constants(len(mask), 31 + seed)):
        if mask[k] == "1":
            total += words[k:m + k] * c
    return mix(total)


def best_overlap(a: np.ndarray, b: np.ndarray, hit: int) -> tuple[int, int, int, int]:
    """Of two aligned word sequences, the run around a hit with the best score: matches, substitutions, start, end."""
    score = np.where(a == b, 1, -PENALTY)
    right = np.cumsum(score[hit:])
    end = hit + int(np.argmax(right)) + 1
    left = np.cumsum(score[:hit][::-1])
    start = hit - (int(np.argmax(left)) + 1) if len(left) and left.max() > 0 else hit
    matches = int((a[start:end] == b[start:end]).sum())
    return matches, end - start - matches, start, end


_TOP = np.uint64(44)


def _filter(hashes: np.ndarray) -> np.ndarray:
    bits = np.zeros(1 << 20, bool)
    bits[(hashes >> _TOP).astype(np.int64)] = True
    return bits


class Block:
    """A block of test items: their words, and the sorted masked hashes with the positions they stand for."""

    def __init__(self, ids: list[int], texts: list[bytes]):
        self.ids = ids
        self.words, self.bounds = compared_words(texts)
        self.lengths = np.diff(self.bounds)
        at = np.arange(len(self.words))
        owner = np.searchsorted(self.bounds, at, "right") - 1
        self.owner = owner
        room = self.bounds[owner + 1] - at >= SPAN
        self.tables = []
        for seed, mask in enumerate(MASKS):
            h = masked_hashes(self.words, mask, seed)
            ok = np.flatnonzero(room[: len(h)])
            order = ok[np.argsort(h[ok], kind="stable")]
            self.tables.append((h[order], order, _filter(h[order])))
        # Short items: the masked hashes of their windows one after another.
        offset = at - self.bounds[owner]
        short = (self.lengths[owner] >= MIN_ITEM) & (self.lengths[owner] < SHORT)
        starts = np.flatnonzero(short & (offset % WINDOW == 0) & (self.lengths[owner] - offset >= WINDOW))
        self.short = []
        for seed, mask in enumerate(SHORT_MASKS, len(MASKS)):
            h = masked_hashes(self.words, mask, seed)[starts] if len(starts) else np.empty(0, np.uint64)
            order = np.argsort(h, kind="stable")
            self.short.append((h[order], starts[order], _filter(h)))

    def suspects(self, words: np.ndarray, bounds: np.ndarray) -> list[int]:
        """Documents of a chunk in which some masked hash may be found."""
        hits = []
        for seed, (mask, (keys, _, bits)) in enumerate(zip(MASKS + SHORT_MASKS, self.tables + self.short)):
            h = masked_hashes(words, mask, seed) if len(keys) else keys
            near = np.flatnonzero(bits[(h >> _TOP).astype(np.int64)]) if len(h) else np.empty(0, np.int64)
            at = np.minimum(np.searchsorted(keys, h[near]), max(len(keys) - 1, 0))
            hits.append(near[keys[at] == h[near]] if len(keys) else near[:0])
        at = np.concatenate(hits)
        return np.unique(np.searchsorted(bounds, at, "right") - 1).tolist()

    def whole_short(self, words: np.ndarray):
        """Places of short items in the words of one document: item, matches, start."""
        tried = set()
        for seed, (mask, (keys, places, bits)) in enumerate(zip(SHORT_MASKS, self.short), len(MASKS)):
            h = masked_hashes(words, mask, seed) if len(keys) else keys
            near = np.flatnonzero(bits[(h >> _TOP).astype(np.int64)])
            low, high = np.searchsorted(keys, h[near], "left"), np.searchsorted(keys, h[near], "right")
            for p, lo, hi in zip(near.tolist(), low.tolist(), high.tolist()):
                for q in places[lo:hi].tolist():
                    item = int(self.owner[q])
                    n, first = int(self.lengths[item]), int(self.bounds[item])
                    start = p - (q - first)
                    if (item, start) in tried or start < 0 or start + n > len(words):
                        continue
                    tried.add((item, start))
                    matches = int((words[start:start + n] == self.words[first:first + n]).sum())
                    if n - matches <= n // WINDOW:
                        yield item, matches, start

    def search(self, words: np.ndarray) -> dict[int, tuple[int, int, int, int]]:
        """Items that the words of one document overlap, with matches, substitutions, start and end word in the document."""
        found: dict[int, tuple[int, int, int, int]] = {}
        seen: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for (keys, places, bits), mask, seed in zip(self.tables, MASKS, range(len(MASKS))):
            h = masked_hashes(words, mask, seed)
            near = np.flatnonzero(bits[(h >> _TOP).astype(np.int64)])
            low, high = np.searchsorted(keys, h[near], "left"), np.searchsorted(keys, h[near], "right")
            for p, lo, hi in zip(near.tolist(), low.tolist(), high.tolist()):
                for q in places[lo:hi].tolist():
                    item, shift = int(self.owner[q]), p - q
                    tried = seen.setdefault((item, shift), [])
                    if any(a <= p < b for a, b in tried):
                        continue
                    first, last = max(int(self.bounds[item]), -shift), min(int(self.bounds[item + 1]), len(words) - shift)
                    matches, subs, a, b = best_overlap(words[first + shift:last + shift], self.words[first:last], q - first)
                    a, b = a + first + shift, b + first + shift
                    tried.append((a, b))
                    enough = matches >= ENOUGH or (matches >= MIN_MATCHES and matches >= MIN_SHARE * self.lengths[item])
                    if enough and matches > found.get(item, (0,))[0]:
                        found[item] = (matches, subs, a, b)
        for item, matches, start in self.whole_short(words):
            if matches > found.get(item, (0,))[0]:
                n = int(self.lengths[item])
                found[item] = (matches, n - matches, start, start + n)
        return found


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_tokens: int = BLOCK_TOKENS):
    """The test items in order of id, in blocks of at most so many words (a longer item makes its own), read one row at a time."""
    rows = items.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).where(F.col(text_col).isNotNull() & F.col(id_col).isNotNull()).orderBy(id_col, text_col)
    ids, texts, n = [], [], 0
    for id_, text in rows.toLocalIterator():
        data = text.encode()
        more = len(data.split())
        if ids and n + more > block_tokens:
            yield ids, texts
            ids, texts, n = [], [], 0
        ids.append(id_)
        texts.append(data)
        n += more
    if ids:
        yield ids, texts


OVERLAPS = "id long, item_id long, n_matches long, n_substitutions long, item_words long, start_word long, end_word long"


def find_overlaps(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """A row for each document and item that contaminates it: the best overlap, in words of the document as compared."""
    spark = docs.sparkSession
    prepare(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text")).where(F.col("text").isNotNull())
    names = ["id", "item_id", "n_matches", "n_substitutions", "item_words", "start_word", "end_word"]
    out = None
    for ids, item_texts in item_blocks(items, item_id_col, item_text_col):
        block = spark.sparkContext.broadcast(Block(ids, item_texts))

        def run(batches, block=block):
            for batch in batches:
                for held in chunks(zip(batch.column(1).to_pylist(), batch.column(0).to_pylist())):
                    words, bounds = compared_words([t for t, _ in held])
                    suspects = block.value.suspects(words, bounds)
                    rows = []
                    for k in suspects:
                        for item, (matches, subs, a, b) in block.value.search(words[bounds[k]:bounds[k + 1]]).items():
                            rows.append((held[k][1], block.value.ids[item], matches, subs, int(block.value.lengths[item]), a, b))
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*rows)], names)

        part = texts.mapInArrow(lean(run), OVERLAPS)
        out = part if out is None else out.union(part)
    return spark.createDataFrame([], OVERLAPS) if out is None else out


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The documents that no item contaminates, all columns. Rows with a null id stay."""
    return without_ids(docs, id_col, find_overlaps(docs, items, id_col, text_col, item_id_col, item_text_col).select("id"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that carries a passage of a test item, with the item and the overlap."""
    docs, items = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return find_overlaps(docs, items).withColumnRenamed("id", "doc_id")
