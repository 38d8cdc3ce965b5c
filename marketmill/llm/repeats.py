"""Repeated windows of a corpus: which runs of `length` tokens occur elsewhere, found without shuffling the corpus.

Every window of `length` tokens has an anchor: the `anchor`-token gram in it
with the smallest hash, the rightmost of equal ones. Equal windows have equal
anchors at equal offsets. Neighbouring windows mostly share one anchor; such a
run of windows is one row of hashes and positions. From these rows:

- runs whose anchor occurs once hold no repeated window and are dropped;
- runs of equal content are a class. All occurrences of a class repeat;
- anchors with several classes (a repeated passage in different surroundings)
  are contested: the content of one occurrence per class is fetched, and the
  windows of the classes of an anchor are compared in one task;
- an anchor with more than GROUP classes is not: its runs are halved by the
  offset of the anchor in the window, and each half is keyed by the tokens that
  all its windows share. Halving ends at single windows, of which all with one
  key are equal. So no group grows with the corpus, and nothing is dropped.

Counts and minima combine before each shuffle. Equality is by two independent
64-bit hashes (anchor and content) for classes, and by content in a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketmill.llm.shared import small, stored
from marketmill.llm.text import _powers, chunks, constants, mix

GROUP = 1000
CHUNK_BYTES = 1 << 19

_BASE = int(constants(1, 61)[0])
_INVERSE = pow(_BASE, -1, 1 << 64)
_TABLES: list[np.ndarray] = []


class Spans:
    """Hashes of any spans of a token sequence."""

    def __init__(self, codes: np.ndarray):
        n = len(codes) + 1
        if not _TABLES or len(_TABLES[0]) < n:
            _TABLES[:] = [_powers(_BASE, max(n, 1 << 21)), _powers(_INVERSE, max(n, 1 << 21))]
        self.down = _TABLES[1]
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(codes * _TABLES[0][:n - 1], out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))

    def grams(self, k: int) -> np.ndarray:
        m = len(self.sums) - k
        return mix((self.sums[k:] - self.sums[:m]) * self.down[:m] + np.uint64(k)) if m > 0 else np.empty(0, np.uint64)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every `width` consecutive values."""
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return np.minimum(values[:len(values) - (width - span)], values[width - span:]) if span < width else values


@dataclass(frozen=True)
class Shape:
    """What repeats: windows of `length` tokens with anchors of `anchor` tokens."""

    length: int
    anchor: int
    #: codes (64-bit, one per token) and for each text the range of its tokens
    codes: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]
    #: the tokens of a text as a sequence whose slices `content` turns into bytes
    tokens: Callable[[bytes], object]
    content: Callable[[object], bytes]
    #: texts with more bytes are taken in pieces, where tokens are bytes
    piece: int | None = None

    def runs(self, texts: list[bytes]) -> dict[str, np.ndarray]:
        """All runs of windows: the text, first and last window, anchor position, and hashes of anchor and content."""
        codes, bounds = self.codes(texts)
        counts = np.maximum(np.diff(bounds) - self.length + 1, 0)
        total = int(counts.sum())
        if not total:
            return {}
        spans = Spans(codes)
        grams = spans.grams(self.anchor)
        packed = (grams & np.uint64(0xFFFFFFFF00000000)) | (np.uint64(0xFFFFFFFF) - np.arange(len(grams), dtype=np.uint64))
        anchors = (np.uint64(0xFFFFFFFF) - (sliding_min(packed, self.length - self.anchor + 1) & np.uint64(0xFFFFFFFF))).astype(np.int64)
        before = np.cumsum(counts) - counts
        windows = np.repeat(bounds[:-1] - before, counts) + np.arange(total)
        anchor = anchors[windows]
        begin = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        end = np.concatenate([begin[1:], [total]]) - 1
        first, last, at = windows[begin], windows[end], anchor[begin]
        text = np.repeat(np.arange(len(texts)), counts)[begin]
        own = bounds[:-1][text]
        return {
            "anchor": grams[at].view(np.int64), "content": spans.hash(first, last + self.length).view(np.int64),
            "text": text, "first": first - own, "last": last - own, "at": at - own,
        }


_RUN = "anchor long, content long, id long, first long, last long, at long, n long, spans array<struct<s:long,e:long>>, later array<struct<s:long,e:long>>"
_SPANS = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))


def merged(starts: np.ndarray, length: int) -> list[dict[str, int]]:
    """The spans that windows of a length at sorted starts cover."""
    cut = np.flatnonzero(np.diff(starts) > length)
    return [{"s": int(s), "e": int(e) + length} for s, e in zip(starts[np.concatenate([[0], cut + 1])], starts[np.concatenate([cut, [len(starts) - 1]])])]


def one_per_text(found: dict[str, np.ndarray], keys: tuple[str, ...], length: int) -> dict:
    """Equal runs of a text as one row: the first of them, their number, what all of them cover, and all but the first. So a word that fills texts makes a row for each."""
    order = np.lexsort([found["first"], *[found[k] for k in keys], found["text"]])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for name in ("text", *keys):
        values = found[name][order]
        new[1:] |= values[1:] != values[:-1]
    head = np.flatnonzero(new)
    counts = np.diff(np.append(head, len(order)))
    out = {name: values[order[head]] for name, values in found.items()} | {"n": counts}
    spans, later = [None] * len(head), [None] * len(head)
    if "content" in keys:
        for k in np.flatnonzero(counts > 1).tolist():
            starts = found["first"][order[head[k]:head[k] + counts[k]]]
            size = int(out["last"][k] - out["first"][k]) + length
            spans[k], later[k] = merged(starts, size), merged(starts[1:], size)
    return out | {"spans": spans, "later": later}


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))


def find_runs(texts: DataFrame, shape: Shape, columns: tuple[str, ...]) -> DataFrame:
    """The runs of all rows id, text: some of the columns of _RUN. Rows without id or text have none."""
    kept = ", ".join(c for c in _RUN.split(", ") if c.split()[0] in columns)
    columns = tuple(c.split()[0] for c in kept.split(", "))

    def pieces(batch):
        for id_, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            step = shape.piece
            if not step or len(text) <= step:
                yield text, id_, 0
            else:
                for start in range(0, len(text), step):
                    yield text[start:start + step + shape.length - 1], id_, start

    def run(batches):
        for batch in small(batches):
            for held in chunks(pieces(batch), CHUNK_BYTES):
                found = shape.runs([t for t, _, _ in held])
                if not found:
                    continue
                start = np.array([s for _, _, s in held])[found["text"]]
                for name in ("first", "last", "at"):
                    found[name] = found[name] + start
                found = one_per_text(found, ("anchor", "content") if "content" in columns else ("anchor",), shape.length)
                found["id"] = np.array([i for _, i, _ in held])[found["text"]]
                yield pa.RecordBatch.from_arrays([pa.array(found[c], _SPANS if c in ("spans", "later") else pa.int64()) for c in columns], list(columns))

    return texts.where("id is not null and text is not null").mapInArrow(run, kept)


def classes_of(runs: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """anchor, content, n, f (the first occurrence: id, first, last, at and extra columns)."""
    return runs.groupBy("anchor", "content").agg(F.sum("n").alias("n"), F.min(F.struct("id", "first", "last", "at", *extra)).alias("f"))


def contested(classes: DataFrame) -> DataFrame:
    """The classes of anchors that have several, with their number."""
    several = classes.groupBy("anchor").agg(F.count("*").alias("classes")).where("classes > 1")
    return classes.join(several, "anchor")


_CLASS = "anchor long, n long, id long, first long, last long, at long, low long, high long, classes long, body binary"


def fetch(texts: DataFrame, classes: DataFrame, shape: Shape) -> DataFrame:
    """_CLASS of contested classes: their content, cut from the document of the first occurrence. Of rows with one id, the one with this content counts."""
    wanted = classes.groupBy(F.col("f.id").alias("id")).agg(F.collect_list(F.struct("anchor", "n", "f.first", "f.last", "f.at", "classes")).alias("runs"))

    def run(batches):
        names = [c.split()[0] for c in _CLASS.split(", ")]
        for batch in small(batches, 16):
            for id_, text, runs in zip(*(batch.column(i).to_pylist() for i in range(3))):
                tokens = shape.tokens(text)
                rows = [
                    (r["anchor"], r["n"], id_, r["first"], r["last"], r["at"], 0, shape.length - shape.anchor, r["classes"], shape.content(tokens[r["first"]:r["last"] + shape.length]))
                    for r in runs if r["last"] + shape.length <= len(tokens)
                ]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.binary() if name == "body" else pa.int64()) for name, c in zip(names, zip(*rows))], names)

    return texts.where("id is not null and text is not null").join(wanted, "id").select("id", "text", "runs").mapInArrow(run, _CLASS)


def halves(rows: DataFrame, shape: Shape) -> DataFrame:
    """Contested classes as runs of half the offsets [low, high] of the anchor in the window, keyed by the tokens that all windows of a half share."""
    signed = lambda *parts: xxhash.xxh64_intdigest(b"\0".join(str(x).encode() if isinstance(x, int) else x for x in parts)) - (1 << 63)
    schema = "anchor long, content long, n long, id long, first long, last long, at long, low long, high long, body binary"

    def run(batches):
        names = [c.split()[0] for c in schema.split(", ")]
        for batch in small(batches):
            out = []
            for anchor, n, id_, first, last, at, low, high, _, body in zip(*(c.to_pylist() for c in batch.columns)):
                tokens, middle = shape.tokens(body), (low + high) // 2
                for lo, hi in ((low, middle), (middle + 1, high)):
                    a, b = max(first, at - hi), min(last, at - lo)
                    if a <= b:
                        shared = shape.content(tokens[at - lo - first:at - hi - first + shape.length])
                        part = shape.content(tokens[a - first:b - first + shape.length])
                        out.append((signed(anchor, lo, shared), signed(part), n, id_, a, b, at, lo, hi, part))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.binary() if name == "body" else pa.int64()) for name, c in zip(names, zip(*out))], names)

    return rows.select(*[c.split()[0] for c in _CLASS.split(", ")]).mapInArrow(run, schema)


def _marked(runs: DataFrame, classes: DataFrame, shape: Shape, keep_first: bool) -> DataFrame:
    """Spans of the runs that occur again as a whole: all of them, or all but the first."""
    both = runs.join(classes.where("n > 1").select("anchor", "content", F.col("f.id").alias("fid"), F.col("f.first").alias("ffirst")), ["anchor", "content"])
    one = F.array(F.struct(F.col("first").alias("s"), (F.col("last") + shape.length).alias("e")))
    every = F.coalesce("spans", one) if "spans" in runs.columns else one
    if keep_first:
        rest = F.coalesce("later", F.filter(one, lambda x: F.lit(False))) if "later" in runs.columns else F.filter(one, lambda x: F.lit(False))
        every = F.when(F.expr("id <> fid or first <> ffirst"), every).otherwise(rest)
    return both.select("id", F.explode(every).alias("x")).select("id", F.col("x.s").alias("start"), F.col("x.e").alias("end"))


def judged(contents: DataFrame, judge: Callable[[list[tuple]], Iterator[tuple[int, int, int]]], shard_bytes: int) -> DataFrame:
    """Spans id, start, end that `judge` finds among whole groups, several at a time; the contents are partitioned and sorted by group."""

    def run(batches):
        held, size, last = [], 0, None

        def spans():
            rows = list(judge(held))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*rows)], ["id", "start", "end"])

        for batch in small(batches):
            for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if size >= shard_bytes and row[0] != last:
                    yield from spans()
                    held, size = [], 0
                last = row[0]
                held.append(row)
                size += len(row[4])
        if held:
            yield from spans()

    return contents.select("anchor", "n", "id", "first", "body").mapInArrow(run, "id long, start long, end long")


def repeated_spans(docs: DataFrame, shape: Shape, keep_first: bool, judge, deal: Callable[[DataFrame], DataFrame], id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = 1 << 20) -> DataFrame:
    """Spans (id, start, end in tokens) that repeated windows cover, all of them or all but the first of each.

    judge gets rows (group, n, id, first window, content) of whole groups and
    yields spans; deal partitions and sorts the rows so that groups stay whole.
    """
    texts = _rows(docs, id_col, text_col)
    suspects = find_runs(texts, shape, ("anchor", "n")).groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor")
    every = find_runs(texts, shape, ("anchor", "content", "id", "first", "last", "at", "n", "spans", "later"))
    runs = stored(every.join(suspects, "anchor", "left_semi"), "repeat-runs")
    classes = stored(classes_of(runs), "repeat-classes")
    found = [_marked(runs, classes, shape, keep_first)]
    rows = stored(fetch(texts, contested(classes), shape), "repeat-contested")
    while True:
        found.append(judged(deal(rows.where(F.col("classes") <= GROUP)), judge, shard_bytes))
        large = rows.where(F.col("classes") > GROUP)
        if large.isEmpty():
            break
        parts = stored(halves(large, shape), "repeat-halves")
        below = stored(classes_of(parts, ("low", "high", "body")), "repeat-classes")
        found.append(_marked(parts, below, shape, keep_first))
        rows = stored(contested(below).select("anchor", "n", "f.*", "classes").select(*[c.split()[0] for c in _CLASS.split(", ")]), "repeat-contested")
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def with_spans(docs: DataFrame, spans: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, text (bytes, null as empty), starts, ends: each document with its spans, in no order."""
    merged_spans = spans.groupBy("id").agg(F.collect_set(F.struct("start", "end")).alias("spans")).select(F.col("id").alias("sid"), "spans.start", "spans.end")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    joined = texts.join(merged_spans, F.col("id") == F.col("sid"), "left")
    none = F.array().cast("array<long>")
    return joined.select("id", "text", F.coalesce("start", none).alias("starts"), F.coalesce("end", none).alias("ends"))


def covered(n: int, starts: list[int], ends: list[int]) -> np.ndarray:
    """Which of n tokens the spans cover."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, ends, -1)
    return np.cumsum(steps[:n]) > 0
