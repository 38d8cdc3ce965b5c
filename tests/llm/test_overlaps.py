"""Overlaps of parts of long items and of short items with substitutions."""

import random
from itertools import combinations

import pytest

from marketmill.llm import decontam

from .conftest import words


def found(doc, item):
    block = decontam.Block([1], [" ".join(item).encode()])
    hashes, bounds = decontam.compared_words([" ".join(doc).encode()])
    return 0 in block.search(hashes) and block.suspects(hashes, bounds) == [0]


@pytest.mark.parametrize("n, part", [(59, 29), (400, 199), (400, 21)])
def test_a_long_passage_counts_whatever_its_share(n, part):
    rng = random.Random(n)
    item = words(rng, n)
    assert found(words(rng, 30) + item[n // 4:n // 4 + part] + words(rng, 30), item)


@pytest.mark.parametrize("n", [5, 6, 9, 10, 11, 12, 13, 14, 15, 17, 20, 23])
def test_short_items_tolerate_one_substitution_in_five_words(n):
    rng = random.Random(n)
    item, before, after = words(rng, n), words(rng, 10), words(rng, 10)
    ways = list(combinations(range(n), n // 5))
    for way in ways if len(ways) < 300 else rng.sample(ways, 300):
        assert found(before + ["Zq" if k in way else w for k, w in enumerate(item)] + after, item)
    too_many = {*range(0, n, 2)}
    assert not found(before + ["Zq" if k in too_many else w for k, w in enumerate(item)] + after, item)
