"""Crowded nodes of near-duplicates lose no pair."""

import random
from collections import defaultdict

import pytest

from marketmill.llm import neardup


@pytest.mark.parametrize("components", [60, 2])
def test_all_pairs_of_a_crowded_node_meet(spark, monkeypatch, components):
    """Members whose minwise values name different children are compared all the same."""
    monkeypatch.setattr(neardup, "LEAF", 8)
    rng = random.Random(4)
    component = {k: max(0, k - 60 + components) for k in range(60)}
    rows = [(7, k, c, bytearray(rng.randbytes(neardup.HASHES)), 10) for k, c in component.items()]
    table = spark.createDataFrame(rows, "node long, id long, component long, sketch binary, size long")
    cells = defaultdict(set)
    for r in neardup.leaves(table).collect():
        cells[r.node].add(r.id)
    met = {(a, b) for c in cells.values() for a in c for b in c}
    assert all((a, b) in met for a in component for b in component if component[a] != component[b])
    assert max(map(len, cells.values())) < 30
    if components == 2:
        assert sum(map(len, cells.values())) < 2 * len(rows)
