import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Names that operators use inside.
    *[T.StructField(n, T.StringType()) for n in ("id", "component", "kept", "_removed", "_mine", "host", "text_", "email")],
])


def words(rng, n):
    return [rng.choice("bcdfgmnprst") + "".join(rng.choice("aeioulnrst") for _ in range(rng.randint(1, 6))) for _ in range(n)]


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        """A documents table with clashing columns from (doc_id, text) or (doc_id, text, source)."""
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1] or ""), *["x"] * 8) for r in rows]
        return spark.createDataFrame(full, SCHEMA)
    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Texts that are null, empty, blank, short, very long, tied and repeated; a null id; a repeated row."""
    rng = random.Random(5)
    base = words(rng, 120)
    long = words(rng, 30_000)
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "One"), (6, " ".join(base)), (7, " ".join(base)), (8, " ".join(base[:100] + words(rng, 20))),
        (9, " ".join(base[:60]) + "\n" + " ".join(base[:60])), (10, " ".join(long)), (11, " ".join(words(rng, 40) + long[500:900] + words(rng, 30))), (12, "x" * 50_000),
        (13, "ä ö ü  日本 \x00 \u0001\u0002 ﬁ é"), (14, "a a a a a a " * 40), (15, " ".join(words(rng, 80))),
    ]
    return [*rows, rows[5], (None, " ".join(base)), (None, None)]
