"""Periodic runs of words: maximal stretches that repeat a shortest pattern four times or more.

A run is a stretch of consecutive words whose smallest period is q (words q
apart are the same), at least max(LEAST_WORDS, LEAST_TURNS * q) long, that no
neighbouring word extends with period q.

The search is tiled by scale. For each octave of periods s <= q < 2s a
document is exploded into overlapping tiles around every s-th word: s words
before this boundary, 8s after it. A run of the octave has a boundary among
its first s words and from there on three periods or more; the last boundary
with so much before the run's end has this end in its tile, the first one its
beginning. So each tile is solved on its own:

1. A tile can only hold a run of the octave where a gram at its boundary comes
   again q words later. All tiles of an octave are asked at once, at one
   comparison for each word of the documents.
2. In the others the Z-function of the words from the boundary on gives for
   every q how far the period reaches to the right, and whether a smaller
   period explains the stretch; how far it reaches to the left is compared
   word by word. What is found is a fragment: document, period, start, end.
   Fragments of a strip of neighbouring tiles are combined. The tiles of the
   octaves below GRAM are solved all at once, by comparing whole arrays.
3. Fragments are shuffled by document and period. Those of one run overlap by
   q words or more and are stitched to one interval; intervals of other runs
   of the same period overlap by fewer than q.
4. The runs come back to their document as a list, which decides the words to
   keep. Only documents with fragments carry their words through a shuffle.

Tiles are made and solved in the task that reads the document, so their words
never travel; the work is n log n in the words of a document, and memory grows
with the document at hand, not with the table.

Defined cases: a null or empty text has no words, no runs and an empty rest.
A null id changes nothing in the text. Rows that repeat, or share an id, have
results of their own. Extra columns play no part. No rows give no rows.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketmill.llm.shared import prepare, small, stored
from marketmill.llm.text import chunks, mix

LEAST_WORDS = 6
LEAST_TURNS = 4
#: Words of the gram that is looked for again, and the lowest period that is searched by tiles of its octave.
GRAM = 8
#: Tiles whose fragments are combined before they are shuffled.
STRIP = 64

_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


# -- tiles -----------------------------------------------------------------

def z_function(words: list[int]) -> list[int]:
    """For each position how many words from there on equal the first ones."""
    n = len(words)
    z, left, right = [n] + [0] * (n - 1), 0, 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and words[k] == words[i + k]:
            k += 1
        if i + k > right:
            left, right = i, i + k
        z[i] = k
    return z


def least_span(period, scale: int):
    """Words from its first boundary on that a run with this period has at least."""
    return np.maximum(LEAST_WORDS, LEAST_TURNS * period) - scale + 1


def solve_tile(words: np.ndarray, boundary: int, scale: int) -> list[tuple[int, int, int]]:
    """Fragments (period, start, end) of the runs with a period of this octave that reach far enough from the boundary on."""
    tile = words[boundary:boundary + 2 * LEAST_TURNS * scale + 1]
    z = np.array(z_function(tile.tolist()))
    reach = np.arange(len(z)) + z
    # The furthest that any smaller period reaches: where it covers the span too, the period is a multiple of a smaller one.
    explained = np.concatenate([[0, 0], np.maximum.accumulate(reach[1:])])[: len(z)]
    periods = np.arange(scale, min(2 * scale, len(z)))
    span = least_span(periods, scale)
    out = []
    for q in periods[(reach[periods] >= span) & (explained[periods] < span)].tolist():
        back = min(scale, boundary)
        wrong = np.flatnonzero(words[boundary - back:boundary] != words[boundary - back + q:boundary + q])
        out.append((q, boundary - back + (int(wrong[-1]) + 1 if len(wrong) else 0), boundary + int(reach[q])))
    return out


def boundaries(words: np.ndarray, grams: np.ndarray, scale: int, cover: np.ndarray):
    """Every scale-th position from which some period of the octave reaches far enough.

    Only distances at which the gram of the position comes again are looked
    at, and no position from where a run of a smaller period goes on for three
    scales: two periods that together are no longer than what they share have
    a common divisor as period, so this octave has nothing of its own there.
    """
    n = (len(grams) - scale) // scale
    if n < 1:
        return
    again = grams[scale: scale + n * scale].reshape(n, scale) == grams[: n * scale: scale, None]
    at = np.flatnonzero(again.any(axis=1))
    for k in at[cover[at * scale] < (at + 3) * scale].tolist():
        b = k * scale
        for q in (np.flatnonzero(again[k]) + scale).tolist():
            end = b + int(least_span(q, scale))
            if end <= len(words) and np.array_equal(words[b:end - q], words[b + q:end]):
                yield b
                break


def joined(pieces: list[tuple[int, int, int]], strip: int) -> list[tuple[int, int, int]]:
    """Fragments of one period that share a period or more made one, within strips of so many words (0: everywhere)."""
    out: list[tuple[int, int, int]] = []
    for q, start, end in sorted(pieces):
        if out and out[-1][0] == q and start + q <= out[-1][2] and (not strip or out[-1][1] // strip == start // strip):
            out[-1] = (q, out[-1][1], max(end, out[-1][2]))
        else:
            out.append((q, start, end))
    return out


def small_periods(words: np.ndarray, cover: np.ndarray) -> list[tuple[int, int, int]]:
    """The octaves below GRAM, whose tiles are a few words each: the Z-values of all boundaries at once are the distances to the next mismatch, so what lies between mismatches is whole."""
    out = []
    for q in range(1, GRAM):
        same = np.concatenate([[False], words[:-q] == words[q:], [False]]) if len(words) > q else np.zeros(2, bool)
        change = np.flatnonzero(same[1:] != same[:-1])
        starts, ends = change[0::2], change[1::2] + q
        whole = ends - starts >= max(LEAST_WORDS, LEAST_TURNS * q)
        for start, end in zip(starts[whole].tolist(), ends[whole].tolist()):
            if cover[start] < end:  # else a run of a smaller period
                cover[start:end] = np.maximum(cover[start:end], end)
                out.append((q, start, end))
    return out


def fragments(words: np.ndarray, upto) -> list[tuple[int, int, int]]:
    """Fragments (period, start, end) of all runs in an array of word numbers, octave by octave. upto: how many words there are in texts of so many words or more."""
    cover = np.zeros(len(words), np.int64)
    out, scale, size, grams = small_periods(words, cover), GRAM, 1, words.astype(np.uint64)
    while (n := upto(LEAST_TURNS * scale)) > 0:
        words = words[:n]
        while size < GRAM:
            grams = mix(grams[:-size] * _ODD[0] + grams[size:] * _ODD[1])
            size *= 2
        # The last text may end within its last tile: what follows is no word.
        padded = np.concatenate([grams[:n], np.arange(4 * scale, dtype=np.uint64) | np.uint64(1 << 63)])
        found = [f for b in boundaries(words, padded, scale, cover) for f in solve_tile(words, b, scale)]
        out += joined(found, STRIP * scale)
        for _, start, end in joined(found, 0):
            np.maximum(cover[start:end], end, out=cover[start:end])
        scale *= 2
    return out


def batch_fragments(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """Fragments of each of several texts, searched as one array.

    No number stands for a word of two texts, and each text ends with one of
    its own, so nothing is found across texts. The longest texts come first:
    an octave looks at those that are long enough for it.
    """
    order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
    lengths = [len(texts[k]) for k in order]
    starts = np.concatenate([[0], np.cumsum([n + 1 for n in lengths])]).astype(np.int64)
    every, used = np.empty(starts[-1], np.int64), 0
    for k, start, n in zip(order, starts.tolist(), lengths):
        known: dict[bytes, int] = {}
        every[start:start + n] = np.fromiter((known.setdefault(w, used + len(known)) for w in texts[k]), np.int64, n)
        every[start + n] = used + len(known)
        used += len(known) + 1
    falling = -np.array(lengths)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for q, start, end in fragments(every, lambda least: int(starts[np.searchsorted(falling, -least, "right")])):
        k = int(np.searchsorted(starts, start, "right")) - 1
        out[order[k]].append((q, start - int(starts[k]), end - int(starts[k])))
    return out


# -- the job ---------------------------------------------------------------

def with_fragments(docs: DataFrame, id_col: str, text_col: str, rewrite=None) -> DataFrame:
    """row, id, n_words, fragments; words (joined by one space) only where there are fragments, and their sha256 where there are none.

    rewrite: a function of the id and the words, before the search.
    """
    def run(batches):
        for batch in small(batches):
            rows = zip((t or b"" for t in batch.column(2).to_pylist()), batch.column(1).to_pylist(), range(batch.num_rows))
            for held in chunks(rows):
                texts = [t.split() if rewrite is None else rewrite(i, t.split()) for t, i, _ in held]
                found = batch_fragments(texts)
                at = pa.array([k for *_, k in held])
                joined = [b" ".join(t) for t in texts]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(at), batch.column(1).take(at), pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([[{"period": q, "start": s, "end": e} for q, s, e in f] for f in found], pa.list_(pa.struct([("period", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))),
                    pa.array([j if f else None for j, f in zip(joined, found)], pa.binary()),
                    pa.array([None if f else hashlib.sha256(j).hexdigest() for j, f in zip(joined, found)], pa.string()),
                ], ["row", "id", "n_words", "fragments", "words", "plain_sha256"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, "row long, id long, n_words long, fragments array<struct<period:long,start:long,end:long>>, words binary, plain_sha256 string")


def stitched(found: DataFrame) -> DataFrame:
    """row, runs: the runs of each row with fragments as a list of (start, length, period), sorted by start, then period."""
    pieces = found.select("row", F.explode("fragments").alias("f")).select("row", "f.period", "f.start", "f.end").distinct()
    order = Window.partitionBy("row", "period").orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(F.col("start") + F.col("period") <= before, 0).otherwise(1)
    marked = pieces.withColumn("new", new).withColumn("interval", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = marked.groupBy("row", "period", "interval").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    length = F.col("end") - F.col("start")
    runs = whole.where(length >= F.greatest(F.lit(LEAST_WORDS), LEAST_TURNS * F.col("period")))
    return runs.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", length.alias("length"), "period"))).alias("runs"))


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without what any run repeats after its first period."""
    steps = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    gone = np.cumsum(steps[:-1]) > 0
    return [w for w, g in zip(words, gone.tolist()) if not g]


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite=None) -> DataFrame:
    """One row per document: id, n_words, runs (start, length, period) and kept, the words left joined by one space, where there are runs; kept_sha256 everywhere."""
    prepare(docs.sparkSession)
    found = stored(with_fragments(docs, id_col, text_col, rewrite), "period-fragments")
    hit = found.where("words is not null").select("row", "id", "n_words", "words").join(stitched(found), "row", "left")

    def run(batches):
        for batch in small(batches):
            lists = [[(r["start"], r["length"], r["period"]) for r in x or []] for x in batch.column(3).to_pylist()]
            kept = [b" ".join(kept_words(w.split(b" "), r)) if r else w for w, r in zip(batch.column(2).to_pylist(), lists)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), pa.array(kept, pa.binary()), pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())], ["id", "n_words", "runs", "kept", "kept_sha256"])

    kind = "array<struct<start:long,length:long,period:long>>"
    schema = f"id long, n_words long, runs {kind}, kept binary, kept_sha256 string"
    some = hit.select("id", "n_words", "words", "runs").mapInArrow(run, schema)
    none = found.where("words is null").select("id", "n_words", F.lit(None).cast(kind).alias("runs"), F.lit(None).cast("binary").alias("kept"), F.col("plain_sha256").alias("kept_sha256"))
    both = some.unionAll(none)
    return both.select("id", "n_words", F.coalesce("runs", F.array().cast(kind)).alias("runs"), F.col("kept").cast("string").alias("kept"), "kept_sha256")


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of the query: in a tenth of the documents, by the checksum of the id, the end repeats with some period."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    turn = words[a:a + p]
    return words[:a] + (turn * (-(-(n - a) // p)))[: n - a]


def op12_period_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, the longest of them, and digests of all and of what is left."""
    found = find_runs(spark.read.parquet(f"{sf_dir}/documents.parquet"), rewrite=planted)
    best = F.element_at(F.sort_array(F.transform("runs", lambda r: F.struct((-r["length"]).alias("short"), r["start"].alias("start"), r["period"].alias("period")))), 1)
    found = found.withColumn("best", F.when(F.size("runs") > 0, best))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    length = -F.col("best.short")
    return found.select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), length.alias("length"), F.col("best.period").alias("period"),
        F.expr("-1000 * best.short div best.period").alias("exponent_milli"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.col("kept_sha256").alias("collapsed_sha256"),
    )
