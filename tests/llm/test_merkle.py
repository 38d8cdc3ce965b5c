"""The Merkle manifest against trees built in memory."""
import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from marketmill.llm import merkle

from .conftest import words

SF = "/root/testdata/sf0.001"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row.doc_id, row.source, row.lang, row.n_chars, text)])


def levels(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][k:k + 16]) for k in range(0, len(out[-1]), 16)])
    return out


def sides(tree, i):
    for level in tree[:-1]:
        first = i // 16 * 16
        run = level[first:first + 16]
        yield run[: i - first], run[i - first + 1:]
        i //= 16


def by_hand(rows):
    """Every result row as text, from whole trees."""
    by_source = {}
    for r in rows:
        by_source.setdefault(r.source, []).append((r.doc_id, leaf(r, r.text), r))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        by_source[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[s] = levels([x[1] for x in by_source[s]])
    top = levels([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, (doc, own, r) in enumerate(by_source[s]):
            path = [*sides(trees[s], i), *sides(top, k)]
            changed = doc is not None and zlib.crc32(str(doc).encode()) % 5 == 0
            low = None if r.text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text)
            at = leaf(r, low) if changed else own
            for left, right in path:
                at = sha(*left, at, *right)
            out.append(str((doc, own, trees[s][-1][0], top[-1][0], sha(*[h for left, right in path for h in left + right]), at, at == top[-1][0])))
    return sorted(out)


def claimed(docs):
    chosen = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    found = merkle.proofs(merkle.build_manifest(docs, claimed=F.when(chosen, merkle.leaf_digest(text=F.translate("text", *merkle._LETTERS)))))
    return sorted(str((r.id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified)) for r in found.collect())


@pytest.mark.parametrize("levels_", [1, 2, 3, 4, 5])
def test_addresses_are_those_of_halved_subtrees(levels_):
    every = np.concatenate([merkle.addresses(levels_, d, np.arange(16 ** d)) for d in range(levels_)])
    assert sorted(every.tolist()) == list(range(merkle.nodes_of(levels_)))
    upper = levels_ // 2
    if upper:
        # The upper half comes first, then each lower subtree as a whole.
        assert max(merkle.addresses(levels_, upper - 1, np.arange(16 ** (upper - 1)))) < merkle.nodes_of(upper)
        size = merkle.nodes_of(levels_ - upper)
        last = merkle.addresses(levels_, levels_ - 1, np.arange(16 ** (levels_ - 1)))
        under = np.arange(16 ** (levels_ - 1)) // 16 ** (levels_ - 1 - upper)
        assert ((last - merkle.nodes_of(upper)) // size == under).all()


@pytest.mark.parametrize("leaves", [1, 2, 16, 17, 255, 256, 257, 700])
def test_a_block_gives_back_its_levels(leaves):
    hashes = [sha(str(k)) for k in range(leaves)]
    tree = levels(hashes)
    block = merkle.Block(merkle.build_block(hashes, len(tree) - 1), leaves, len(tree) - 1)
    for step, level in enumerate(tree):
        assert block.read(step, 0, len(level)) == level
    for i, (own, path) in enumerate(block.paths()):
        assert own == hashes[i] and path == tuple(("".join(left), "".join(right)) for left, right in sides(tree, i))
        assert merkle.folded(own, path) == tree[-1][0]
    assert leaves == 1 or merkle.folded(sha("else"), path) != tree[-1][0]


@pytest.mark.parametrize("block_levels", [1, 3])
def test_proofs_equal_whole_trees(spark, make_docs, odd_rows, monkeypatch, block_levels):
    """With blocks of 16 leaves the trees have up to three tiers, those of the sources too."""
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", block_levels)
    monkeypatch.setattr(merkle, "BLOCK_LEAVES", 16 ** block_levels)
    rng = random.Random(6)
    rows = [(k, " ".join(words(rng, 5)).upper(), "hot") for k in range(1000, 1700)] + [(k, "Ab", f"s{k % 40}é" if k % 3 else None) for k in range(300)] + [(i, t, "odd") for i, t in odd_rows]
    rng.shuffle(rows)
    docs = make_docs(rows)
    assert claimed(docs) == by_hand(docs.collect())


def test_no_rows_and_one_row(spark, make_docs):
    assert claimed(make_docs([])) == [] and merkle.build_manifest(make_docs([])).root is None
    docs = make_docs([(3, "x")])
    assert claimed(docs) == by_hand(docs.collect())


def test_query_equals_sql_and_whole_trees(spark):
    got = merkle.op13_merkle_manifest(spark, SF)
    rows = got.collect()
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.sql(merkle.OP13_SQL)
    assert want.columns == got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    mine = sorted(str(tuple(r)) for r in rows)
    assert mine == sorted(map(str, want.fetchall())) == by_hand(spark.read.parquet(f"{SF}/documents.parquet").collect())
    assert {r.verified for r in rows} == {True, False}
