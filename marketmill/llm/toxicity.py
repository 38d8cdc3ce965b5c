"""Toxicity scores by a counterfactually regularised classifier.

A logistic regression over the words that a text contains and how they begin.
Every labelled text that mentions a group has two counterfactuals: each identity
term swapped for the next one of its list, and each left out. The squared change
of the score's logit is added to the loss. So neither the group nor its mention
can move the score, and neutral texts about a group are not taken for toxic
because toxic ones mention it.

Fitting takes a bounded sample: SAMPLE labelled documents, those with the
smallest hash of their id, and features in at least LEAST_DOCUMENTS of them whose share
differs between the labels by LEAST_Z standard errors.
Documents whose crc32 of the id as text leaves 1 modulo 3 are held out: they
are never fitted on. Scores cover every document and its whole text.

Defined cases: null and empty texts get the score of a text without known
words. A null id is not held out and has no label. Of several labels of one id
the highest counts; null labels count as none. Where the labels fitted on are
all equal, or there are none, every score is their mean, or 0. Rows that repeat
get the same score. No rows give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketmill.llm.decontam import compared_words, trimmed_words
from marketmill.llm.shared import prepare
from marketmill.llm.text import chunks, word_hashes

SAMPLE = 12_000
LEAST_DOCUMENTS = 5
#: Standard errors by which a feature's share must differ between the labels; chance reaches this about once in 16,000 features.
LEAST_Z = 4.0
THRESHOLD = 0.7
#: Bytes of a word's beginning that are a feature of their own, so that forms of one stem share it.
BEGINNINGS = (4, 5, 6)
RIDGE = 2e-5
PENALTY = 1.0
STEPS = 200

#: Terms that can stand for each other in a sentence about people.
IDENTITY_LISTS = (
    ("muslim", "christian", "jewish", "hindu", "buddhist", "sikh", "atheist", "catholic"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "sikhs", "atheists", "catholics"),
    ("black", "white", "asian", "african", "european", "arab", "latino", "indigenous"),
    ("blacks", "whites", "asians", "africans", "europeans", "arabs", "latinos"),
    ("gay", "lesbian", "bisexual", "straight", "transgender", "queer", "heterosexual", "homosexual"),
    ("woman", "man", "girl", "boy"), ("women", "men", "girls", "boys"), ("female", "male"),
    ("immigrant", "refugee", "foreigner", "citizen", "migrant"), ("immigrants", "refugees", "foreigners", "citizens", "migrants"),
    ("disabled", "blind", "deaf", "autistic", "elderly", "young"),
    ("musulman", "chrétien", "juif", "hindou", "bouddhiste"), ("femme", "homme"), ("femmes", "hommes"),
    ("moslem", "christ", "jude", "hinduist", "buddhist"), ("frau", "mann"), ("frauen", "männer"),
    ("musulmán", "cristiano", "judío", "budista"), ("mujer", "hombre"), ("mujeres", "hombres"),
)


def word_codes(words: list[str]) -> np.ndarray:
    """The codes that the words of texts have as features."""
    return compared_words([w.encode() for w in words])[0]


def features(texts: list[bytes]) -> list[np.ndarray]:
    """The distinct codes of each text's words and of how they begin, sorted."""
    data, starts, ends, bounds = trimmed_words(texts)
    codes, owners = [word_hashes(data, starts, ends)], [np.arange(len(starts))]
    for length in BEGINNINGS:
        long = np.flatnonzero(ends - starts > length)
        codes.append(word_hashes(data, starts[long], starts[long] + length) * np.uint64(2 * length + 1))
        owners.append(long)
    every, owner = np.concatenate(codes), np.concatenate(owners)
    text = np.searchsorted(bounds, owner, "right") - 1
    order = np.argsort(text, kind="stable")
    cuts = np.searchsorted(text[order], np.arange(len(texts) + 1))
    every = every[order]
    return [np.unique(every[s:e]) for s, e in zip(cuts, cuts[1:])]


def swaps() -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Each identity term's code to its own features and those of the next one of its list."""
    out = {}
    for terms in IDENTITY_LISTS:
        codes, own = word_codes(list(terms)).tolist(), features([t.encode() for t in terms])
        for code, mine, other in zip(codes, own, own[1:] + own[:1]):
            out.setdefault(code, (mine, other))
    return out


def counterfactuals(codes: np.ndarray, table: dict) -> tuple[np.ndarray, np.ndarray]:
    """The features of the text with its identity terms swapped, and without them."""
    terms = [table[c] for c in codes.tolist() if c in table]
    bare = np.setdiff1d(codes, np.concatenate([mine for mine, _ in terms]))
    return np.union1d(bare, np.concatenate([other for _, other in terms])), bare


class Model:
    """Weights of known words (codes sorted) and the intercept."""

    def __init__(self, codes: np.ndarray, weights: np.ndarray, intercept: float):
        self.codes, self.weights, self.intercept = codes, weights, intercept

    def logits(self, texts: list[bytes]) -> np.ndarray:
        if not len(self.codes):
            return np.full(len(texts), self.intercept)
        found = features(texts)
        every = np.concatenate(found)
        at = np.minimum(np.searchsorted(self.codes, every), len(self.codes) - 1)
        part = np.where(self.codes[at] == every, self.weights[at], 0.0)
        return self.intercept + np.bincount(np.repeat(np.arange(len(texts)), [len(f) for f in found]), part, len(texts))

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(texts), -30, 30)))


def fit(examples: list[np.ndarray], labels: np.ndarray, penalty: float = PENALTY, least: int = LEAST_DOCUMENTS) -> Model:
    """Fit on feature lists and 0/1 labels: logistic loss, ridge, and the counterfactual penalty."""
    empty = np.empty(0, np.uint64)
    n = len(labels)
    if n == 0 or labels.min() == labels.max():
        mean = float(labels.mean()) if n else 0.0
        return Model(empty, np.empty(0), float(np.clip(np.log(max(mean, 1e-13) / max(1 - mean, 1e-13)), -30, 30)))
    known, counts = np.unique(np.concatenate(examples), return_counts=True)
    table = swaps()
    toxic = np.zeros(len(known), np.int64)
    for codes, label in zip(examples, labels):
        if label:
            toxic[np.searchsorted(known, codes)] += 1
    ones = int(labels.sum())
    share = counts / n
    z = (toxic / ones - (counts - toxic) / (n - ones)) / np.sqrt(share * (1 - share) * (1 / ones + 1 / (n - ones)) + 1e-30)
    known = np.union1d(known[(counts >= least) & (np.abs(z) >= LEAST_Z)], np.concatenate([mine for mine, _ in table.values()]))

    def sparse(rows):
        owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        codes = np.concatenate([*rows, empty])
        at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
        ok = known[at] == codes
        return owner[ok], at[ok]

    row, column = sparse(examples)
    # Only texts with an identity term have counterfactuals: +1 for what they have, -1 for what those have.
    terms = np.array(sorted(table), np.uint64)
    named = [e for e in examples if np.isin(terms, e).any() for _ in range(2)]
    before, after = sparse(named), sparse([c for e in named[::2] for c in counterfactuals(e, table)])
    pair = np.concatenate([before[0], after[0]])
    part = np.concatenate([before[1], after[1]])
    sign = np.concatenate([np.ones(len(before[0])), -np.ones(len(after[0]))])

    size = len(known)
    w, bias = np.zeros(size), float(np.log(labels.mean() / (1 - labels.mean())))
    m, v, mb, vb = np.zeros(size), np.zeros(size), 0.0, 0.0
    for step in range(1, STEPS + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, w[column], n) + bias, -30, 30)))
        error = (p - labels) / n
        gradient = np.bincount(column, error[row], size) + 2 * RIDGE * w
        if named:
            change = np.bincount(pair, sign * w[part], len(named))
            gradient += 2 * penalty / len(named) * np.bincount(part, sign * change[pair], size)
        g = error.sum()
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        mb, vb = 0.9 * mb + 0.1 * g, 0.99 * vb + 0.01 * g * g
        a, b = 1 - 0.9**step, 1 - 0.99**step
        w -= 0.1 * (m / a) / (np.sqrt(v / b) + 1e-8)
        bias -= 0.1 * (mb / a) / (np.sqrt(vb / b) + 1e-8)
    return Model(known, w, bias)


def held_out(id_col: str | Column) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_features(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Features and labels of the sample, bounded by its size; features are made by tasks."""
    chosen = (
        labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label")).where("id is not null and label is not null").where(~held_out("id"))
        .groupBy("id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(sample)
    )

    def run(batches):
        for batch in batches:
            for held in chunks(zip(batch.column(1).to_pylist(), batch.column(0).to_pylist(), batch.column(2).to_pylist())):
                found = features([t or b"" for t, _, _ in held])
                yield pa.RecordBatch.from_arrays([pa.array([i for _, i, _ in held], pa.int64()), pa.array([y for _, _, y in held], pa.int32()), pa.array([f.tobytes() for f in found], pa.binary())], ["id", "label", "codes"])

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    # At most `sample` ids: their number is the bound of the broadcast.
    rows = texts.join(F.broadcast(chosen), "id").select("id", "text", "label").mapInArrow(run, "id long, label int, codes binary").collect()
    rows.sort(key=lambda r: (r.id, bytes(r.codes)))
    return [np.frombuffer(r.codes, np.uint64) for r in rows], np.array([r.label > 0 for r in rows], float)


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE, penalty: float = PENALTY) -> DataFrame:
    """id, held_out, score, predicted for every document."""
    spark = docs.sparkSession
    prepare(spark)
    model = spark.sparkContext.broadcast(fit(*labelled_features(docs, labels, id_col, text_col, label_col, sample), penalty))

    def run(batches):
        for batch in batches:
            for held in chunks(zip((t or b"" for t in batch.column(1).to_pylist()), batch.column(0).to_pylist())):
                scores = model.value.scores([t for t, _ in held])
                yield pa.RecordBatch.from_arrays([pa.array([i for _, i in held], pa.int64()), pa.array(scores)], ["id", "score"])

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return texts.mapInArrow(run, "id long, score double").select("id", held_out("id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of every document, from a model fitted on labels that are not held out."""
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score_toxicity(docs, labels).withColumnRenamed("id", "doc_id")
