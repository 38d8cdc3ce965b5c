"""Suffix-array dedup of bytes: of every LENGTH-byte string that occurs more than once, all but the first occurrence are removed.

The suffixes to sort are not those of the whole corpus: repeats.py leaves only
the strings whose anchor occurs elsewhere, one per different content. These are
range-partitioned by their leading tokens (the bytes from the anchor on), with
splitters that Spark samples; each bucket sorts its suffixes by multikey
quicksort, eight bytes at a time, in which only suffixes that are still equal go
on to the next key, and compares neighbours. Suffixes that may be equal lead
with the same anchor, so no splitter falls between them and equal suffixes never
lie on two sides of a boundary.

The first occurrence is the one with the smallest id, then the earliest start.
Strings never cross documents, are judged on the input, and may overlap.

Defined cases: null and empty texts have no bytes. A null id takes part in
nothing and keeps its bytes. Rows that repeat an id with the same text are the
same occurrences: what is first in one is first in all. No rows give no rows.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketmill.llm.repeats import Shape, covered, repeated_spans, with_spans
from marketmill.llm.shared import prepare, small
from marketmill.llm.text import constants

LENGTH = 100
ANCHOR = 24
SHARD_BYTES = 2 << 20
PIECE = 4 << 20


def _codes(texts):
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    return constants(256, 67)[np.frombuffer(b"".join(texts), np.uint8)], np.concatenate([[0], np.cumsum(lengths)])


def _same(text):
    return text


SHAPE = Shape(LENGTH, ANCHOR, _codes, _same, _same, PIECE)


def equal_suffixes(data: np.ndarray, starts: np.ndarray, group: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Which suffixes share their first `length` bytes with another of their group: their indices, and a number for each set of equals.

    Multikey quicksort on 8-byte keys: sort by the key within each set, split
    where it changes, and go on with the sets of two or more.
    """
    key = np.zeros(len(data) + 8, np.uint64)
    padded = np.concatenate([data, np.zeros(16, np.uint8)]).astype(np.uint64)
    for k in range(8):
        key |= padded[k:k + len(key)] << np.uint64(56 - 8 * k)
    rest = np.arange(len(starts))
    for at in [*range(0, length - 7, 8), length - 8]:
        now = key[starts[rest] + at]
        order = np.lexsort((now, group))
        rest, now, group = rest[order], now[order], group[order]
        new = np.concatenate([[True], (now[1:] != now[:-1]) | (group[1:] != group[:-1])])[:len(rest)]
        number = np.cumsum(new) - 1
        several = np.bincount(number, minlength=1)[number] > 1 if len(number) else new
        rest, group = rest[several], number[several]
    return rest, group


def judge(rows: list[tuple]):
    """Spans of the strings of a bucket's contents that occur earlier in another of its contents."""
    bodies = [r[4] for r in rows]
    data = np.frombuffer(b"".join(bodies), np.uint8)
    sizes = np.fromiter(map(len, bodies), np.int64, len(bodies))
    counts = sizes - LENGTH + 1
    before = np.cumsum(counts) - counts
    owner = np.repeat(np.arange(len(rows)), counts)
    offset = np.arange(int(counts.sum())) - before[owner]
    _, group = np.unique(np.array([r[0] for r in rows], np.int64), return_inverse=True)
    found, number = equal_suffixes(data, (np.cumsum(sizes) - sizes)[owner] + offset, group[owner], LENGTH)
    ids = np.array([r[2] for r in rows], np.int64)[owner[found]]
    starts = np.array([r[3] for r in rows], np.int64)[owner[found]] + offset[found]
    order = np.lexsort((starts, ids, number))
    ids, starts, number = ids[order], starts[order], number[order]
    head = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]])[:len(number)])
    first = np.repeat(head, np.diff(np.append(head, len(number))))
    later = np.flatnonzero((ids != ids[first]) | (starts != starts[first])) if len(ids) else head
    order = np.lexsort((starts[later], ids[later]))
    ids, starts = ids[later][order], starts[later][order]
    cut = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]) | (starts[1:] > starts[:-1] + 1)])[:len(ids)])
    for s, e in zip(cut.tolist(), [*cut[1:].tolist(), len(ids)]):
        yield int(ids[s]), int(starts[s]), int(starts[e - 1]) + LENGTH


def _deal(rows: DataFrame) -> DataFrame:
    lead = F.substring("body", (F.col("at") - F.col("first") + 1).cast("int"), F.lit(ANCHOR))
    return rows.withColumn("lead", lead).repartitionByRange("lead", "anchor").sortWithinPartitions("lead", "anchor")


def find_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans id, start, end (in bytes) of strings that occur earlier."""
    prepare(docs.sparkSession)
    return repeated_spans(docs, SHAPE, True, judge, _deal, id_col, text_col, SHARD_BYTES)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept: the bytes left."""

    def run(batches):
        for batch in small(batches):
            ids, texts, starts, ends = (batch.column(i).to_pylist() for i in range(4))
            removed, spans, kept = [], [], []
            for text, s, e in zip(texts, starts, ends):
                if s:
                    gone = covered(len(text), s, e)
                    spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
                    kept.append(np.frombuffer(text, np.uint8)[~gone].tobytes())
                else:
                    spans.append(0)
                    kept.append(text)
                removed.append(len(text) - len(kept[-1]))
            columns = [pa.array(c, pa.int64()) for c in (ids, list(map(len, texts)), removed, spans)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(kept, pa.binary())], ["id", "n_bytes", "n_removed", "n_spans", "kept"])

    return with_spans(docs, find_repeats(docs, id_col, text_col), id_col, text_col).mapInArrow(run, "id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op9_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the bytes that stay when later copies of strings are removed."""
    left = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return left.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
