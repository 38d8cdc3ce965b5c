"""Quality rules: statistics of each text, and lines that too many documents of a host share.

A line counts as the same after lower-casing, digits to 0 and single spaces.
It is above the limit where more than LINE_DOCUMENTS documents of its host have
it, whatever their share, or where more than LINE_SHARE of them have it and
more than SHARED_DOCUMENTS in number. Such lines are removed. A
document is rejected if its words are fewer than MIN_WORDS, if more than
REPEAT_PERCENT of them are in repeated three-word windows, or if removing
lines leaves less than KEPT_SHARE of its words.

Defined cases: a null text has no words and is rejected. A null host is a host
of its own. Documents are told apart by their id: rows of one id and host are
one document for the limits, and share the list of removed lines; rows without
an id are documents of their own. Rows that repeat get the same result. Extra columns pass
through, whatever their names. No rows give no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketmill.llm.shared import SPACES, lean, new_name, prepare, small, stored
from marketmill.llm.text import Words, chunks

MIN_WORDS = 50
REPEAT_PERCENT = 50
LINE_SHARE = 0.05
SHARED_DOCUMENTS = 20
LINE_DOCUMENTS = 500
KEPT_SHARE = 0.3

_SPACE_BYTES = SPACES.encode()
_SYMBOLS = b"#*$%&|<>"
_DIGITS = re.compile(rb"[0-9]")

_STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def line_hash(words: list[bytes]) -> int:
    """Signed 64-bit hash of a normalised line."""
    return xxhash.xxh64_intdigest(_DIGITS.sub(b"0", b" ".join(words).lower())) - (1 << 63)


def repeat_words(texts: list[bytes]) -> np.ndarray:
    """For each text, how many words are in three-word windows that occur twice or more in it."""
    words = Words(texts)
    grams, ranges = words.grams(3)
    owner = np.repeat(np.arange(len(texts)), np.diff(ranges))
    order = np.lexsort((grams, owner))
    same = (grams[order][1:] == grams[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    again = np.zeros(len(grams), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    hit = np.flatnonzero(again)
    at = words.bounds[:-1][owner[hit]] + hit - ranges[:-1][owner[hit]]
    covered = np.zeros(len(words.hashes) + 1, bool)
    for k in range(3):
        covered[at + k] = True
    sums = np.concatenate([[0], np.cumsum(covered)])
    return sums[words.bounds[1:]] - sums[words.bounds[:-1]]


def line_words(text: bytes) -> tuple[list[tuple[int, int]], int]:
    """Distinct normalised lines with a word as (hash, words over all their copies), and the number of lines equal to an earlier one."""
    seen, found, again = set(), {}, 0
    for line in text.split(b"\n"):
        if words := line.split():
            again += line in seen
            seen.add(line)
            key = line_hash(words)
            found[key] = found.get(key, 0) + len(words)
    return list(found.items()), again


def text_stats(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """One narrow row per document: id, host, the statistics, and its distinct lines."""
    lines = pa.list_(pa.struct([("hash", pa.int64()), ("words", pa.int32())]))

    def run(batches):
        for batch in batches:
            rows = zip((t or b"" for t in batch.column(1).to_pylist()), range(batch.num_rows))
            for held in chunks(rows):
                texts = [t for t, _ in held]
                at = pa.array([i for _, i in held])
                found = [line_words(t) for t in texts]
                n_space = [len(t) - len(t.translate(None, _SPACE_BYTES)) for t in texts]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(at), batch.column(2).take(at),
                    pa.array([len(t.split()) for t in texts], pa.int64()),
                    pa.array([len(t.decode()) - n for t, n in zip(texts, n_space)], pa.int64()),
                    pa.array([len(t) - len(t.translate(None, _SYMBOLS)) for t in texts], pa.int64()),
                    pa.array([again for _, again in found], pa.int64()), pa.array(repeat_words(texts), pa.int64()),
                    pa.array([[{"hash": h, "words": n} for h, n in one] for one, _ in found], lines),
                ], ["id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"), F.coalesce(F.col(host_col).cast("string"), F.lit("\0")).alias("host"))
    return rows.mapInArrow(lean(run), f"id long, host string, {_STATS}, lines array<struct<hash:long,words:int>>")


def common_lines(stats: DataFrame, line_share: float = LINE_SHARE, shared_documents: int = SHARED_DOCUMENTS, line_documents: int = LINE_DOCUMENTS) -> DataFrame:
    """host, hash of the lines above a limit. Documents are counted by their different ids, which combine before each shuffle."""
    document = F.struct("id", F.when(F.col("id").isNull(), F.col("row")).alias("row")).alias("document")
    sizes = stats.select("host", document).groupBy("host").agg(F.count_distinct("document").alias("n_docs"))
    lines = stats.select("host", document, F.explode("lines.hash").alias("hash"))
    counts = lines.groupBy("host", "hash").agg(F.count_distinct("document").alias("n"))
    share = F.col("n") > line_share * F.col("n_docs")
    return counts.where(F.col("n") > min(shared_documents, line_documents)).join(sizes, "host").where((F.col("n") > line_documents) | (F.col("n") > shared_documents) & share).select("host", "hash")


SALTS = 32


def removed_lines(stats: DataFrame, common: DataFrame) -> DataFrame:
    """id, host, removed: hashes of the common lines of each document that has any. A line that most documents have is joined over SALTS keys."""
    lines = stats.select("id", "host", F.explode("lines.hash").alias("hash")).withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    salted = common.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return lines.join(salted, ["host", "hash", "salt"], "left_semi").groupBy("id", "host").agg(F.collect_set("hash").alias("removed"))


def judge(stats: DataFrame, removed: DataFrame) -> DataFrame:
    """The statistics with n_removed_words, base_failed and kept."""
    none = F.array().cast("array<long>")
    both = stats.join(removed.withColumnRenamed("id", "rid").withColumnRenamed("host", "rhost"), F.expr("id <=> rid and host <=> rhost"), "left").withColumn("removed", F.coalesce("removed", none))
    gone = F.aggregate(F.filter("lines", lambda x: F.array_contains("removed", x["hash"])), F.lit(0).cast("long"), lambda s, x: s + x["words"])
    both = both.withColumn("n_removed_words", F.when(F.size("removed") > 0, gone).otherwise(F.lit(0).cast("long")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    kept = ~failed & (F.col("n_words") - F.col("n_removed_words") >= KEPT_SHARE * F.col("n_words"))
    return both.select("id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_words", "removed", failed.alias("base_failed"), kept.alias("kept"))


def quality_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One row per document: id, host, statistics, removed lines, base_failed and kept."""
    prepare(docs.sparkSession)
    # The number of a row tells documents without an id apart.
    stats = stored(text_stats(docs, id_col, text_col, host_col).withColumn("row", F.monotonically_increasing_id()), "quality-stats")
    return judge(stats, removed_lines(stats, common_lines(stats)))


def without_lines(text: bytes, removed: set[int]) -> bytes:
    """The text without the lines whose hash is in the set."""
    return b"\n".join(line for line in text.split(b"\n") if not (words := line.split()) or line_hash(words) not in removed)


def clean_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The kept documents with all their columns, their common lines removed from the text.

    Only ids of rejected documents and of documents that lose lines are joined back.
    """
    verdicts = stored(quality_verdicts(docs, id_col, text_col, host_col).select("id", "host", "removed", "kept").where("not kept or size(removed) > 0"), "quality-verdicts").distinct()
    wanted = T.StructType(docs.schema.fields)
    mark, other_id, other_host, other_kept = (new_name(docs, n) for n in ("_removed", "_other_id", "_other_host", "_other_kept"))
    verdicts = verdicts.select(F.col("id").alias(other_id), F.col("host").alias(other_host), F.col("removed").alias(mark), F.col("kept").alias(other_kept))
    joined = docs.join(verdicts, F.col(id_col).cast("long").eqNullSafe(F.col(other_id)) & F.coalesce(F.col(host_col).cast("string"), F.lit("\0")).eqNullSafe(F.col(other_host)), "left")
    kept = joined.where(F.coalesce(other_kept, F.lit(True)))
    place = docs.columns.index(text_col)

    def rewrite(batches):
        for batch in small(batches):
            gone = batch.column(batch.num_columns - 1).to_pylist()
            texts = batch.column(place).to_pylist()
            new = [without_lines(t.encode(), set(g)).decode() if g and t else t for t, g in zip(texts, gone)]
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns[place] = pa.array(new, columns[place].type)
            yield pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(columns))])

    plain = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(wanted.fields)])
    return kept.select(*[F.col(c) for c in docs.columns], mark).mapInArrow(lean(rewrite), plain).toDF(*docs.columns)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document."""
    verdicts = quality_verdicts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return verdicts.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed_words")


_W = r"[^\x20\x09-\x0D]+"
OP8_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(source, chr(1)) AS host, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_W}') AS w,
    row_number() OVER () AS rn FROM documents
), grams AS (
  SELECT rn, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram
  FROM (SELECT rn, w, unnest(range(1, len(w) - 1)) AS i FROM d)
), again AS (
  SELECT rn, i, count(*) OVER (PARTITION BY rn, gram) AS n FROM grams
), covered AS (
  SELECT rn, count(DISTINCT i + k) AS n_repeat_words FROM again, (VALUES (0), (1), (2)) AS v(k) WHERE n > 1 GROUP BY rn
), raw AS (
  SELECT rn, doc_id, host, line, regexp_extract_all(line, '{_W}') AS lw FROM (SELECT rn, doc_id, host, unnest(string_split(text, chr(10))) AS line FROM d)
), lines AS (
  SELECT rn, doc_id, host, line, len(lw) AS n,
    regexp_replace(translate(array_to_string(lw, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9]', '0', 'g') AS norm
  FROM raw WHERE len(lw) > 0
), dup AS (
  SELECT rn, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY rn
), sizes AS (
  SELECT host, count(DISTINCT doc_id) + count(*) FILTER (doc_id IS NULL) AS n_docs FROM d GROUP BY host
), freq AS (
  SELECT host, norm, count(DISTINCT doc_id) + count(DISTINCT rn) FILTER (doc_id IS NULL) AS c FROM lines GROUP BY host, norm
), gone AS (
  SELECT l.rn, sum(l.n) AS n_gone FROM lines l JOIN freq USING (host, norm) JOIN sizes USING (host)
  WHERE c > {LINE_DOCUMENTS} OR c > {SHARED_DOCUMENTS} AND c > {LINE_SHARE} * n_docs GROUP BY l.rn
), stats AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(n_gone, 0) AS BIGINT) AS n_removed_words
  FROM d LEFT JOIN covered USING (rn) LEFT JOIN dup USING (rn) LEFT JOIN gone USING (rn)
)
SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words) AND n_words - n_removed_words >= {KEPT_SHARE} * n_words AS kept
FROM stats
"""
