"""Periodic runs against a search over every period."""
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketmill.llm import periods

from .conftest import words

SF = "/root/testdata/sf0.001"


def every_run(text_words):
    """(start, length, period) of all runs, period by period over the whole text."""
    known = {}
    w = np.array([known.setdefault(x, len(known)) for x in text_words], np.int64)
    out = {}
    for q in range(1, len(w) // 4 + 1):
        same = np.concatenate([[0], (w[:-q] == w[q:]).astype(int), [0]])
        turns = np.flatnonzero(np.diff(same))
        for s, e in zip(turns[0::2].tolist(), turns[1::2].tolist()):
            if e + q - s >= max(6, 4 * q):
                out.setdefault((s, e + q - s), q)
    return sorted((s, n, q) for (s, n), q in out.items())


def left(text_words, runs):
    return [w for i, w in enumerate(text_words) if not any(s + q <= i < s + n for s, n, q in runs)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def split(text):
    return [w.decode() for w in (text or "").encode().split()]


def random_words(rng, n):
    kinds = rng.choice([1, 2, 3, 10, 100])
    w = [str(rng.randrange(kinds)) for _ in range(n)]
    for _ in range(rng.randint(0, 3)):
        if n:
            a = rng.randrange(n)
            p, upto = rng.randint(1, max(1, (n - a) // 3)), rng.randint(a, n)
            for i in range(a + p, upto):
                w[i] = w[i - p]
    return w


def test_z_function():
    rng = random.Random(1)
    for _ in range(200):
        w = [rng.randrange(2) for _ in range(rng.randint(1, 30))]
        assert periods.z_function(w) == [next((k for k in range(len(w) - i) if w[k] != w[i + k]), len(w) - i) for i in range(len(w))]


def test_fragments_of_tiles_are_parts_of_runs():
    """Each fragment has its period, and those of a run reach from its start to its end without a gap."""
    rng = random.Random(2)
    seen = 0
    for _ in range(300):
        w = [x.encode() for x in random_words(rng, rng.choice([5, 80, 400, 900]))]
        runs = every_run(w)
        found = periods.batch_fragments([[b"0"] * 3, w, []])
        assert found[0] == found[2] == []
        for s, n, q in runs:
            own = sorted((a, b) for p, a, b in found[1] if p == q and a >= s and b <= s + n)
            assert own[0][0] == s and max(b for _, b in own) == s + n
            assert all(b[0] + q <= a[1] for a, b in zip(own, own[1:]))
            seen += len(own) > 1
        assert all(w[a:b - p] == w[a + p:b] for p, a, b in found[1])
    assert seen


@pytest.mark.parametrize("strip", [1, 64])
def test_runs_equal_the_search_over_all_periods(spark, make_docs, odd_rows, monkeypatch, strip):
    monkeypatch.setattr(periods, "STRIP", strip)
    rng = random.Random(3)
    rows = odd_rows + [(100 + k, " ".join(random_words(rng, rng.choice([3, 60, 300, 1500])))) for k in range(150)] + [(300, "x " * 30_000), (301, " ".join(words(rng, 4000) * 5)), (100, "a b " * 9), (302, ("a " * 8 + "b ") * 8)]
    docs = make_docs(rows)
    got = periods.find_runs(docs).collect()
    want = []
    for i, text in rows:
        w = split(text)
        runs = every_run(w)
        kept = " ".join(left(w, runs)) if len(runs) < 400 else " ".join(w[:1])
        want.append(str((i, len(w), runs, sha(kept))))
    assert sorted(want) == sorted(str((r.id, r.n_words, [tuple(x) for x in r.runs], r.kept_sha256)) for r in got)
    assert all(r.kept is None or hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256 for r in got)
    assert periods.find_runs(make_docs([])).count() == 0


def test_query_equals_the_definition(spark):
    got = periods.op12_period_runs(spark, SF)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert [t for _, t in got.dtypes] == ["bigint"] * 6 + ["string"] * 2
    want = []
    for d in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        w, h = split(d.text), zlib.crc32(str(d.doc_id).encode())
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
        runs = every_run(w)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        longest = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
        want.append(str((d.doc_id, len(runs), *longest, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(left(w, runs))))))
    rows = got.collect()
    assert sorted(want) == sorted(str(tuple(r)) for r in rows)
    assert sum(r.n_runs > 0 for r in rows) > 10
    assert got.where((F.col("n_runs") == 0) != F.col("period").isNull()).isEmpty()
