"""Near-duplicates and repeated passages against brute force."""
import hashlib
import random
from collections import Counter, defaultdict

import pytest

from marketmill.llm import neardup, repeats, substring, suffixes
from marketmill.llm.shared import connected_components

from .conftest import words


def shingles(text):
    w = [x.lower() for x in (text or "").encode().split()]
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i:i + 5]) for i in range(len(w) - 4)])


def components(rows):
    """Smallest id reachable over links of all pairs."""
    ids = sorted({i for i, _ in rows if i is not None})
    label = {i: i for i in ids}
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    changed = True
    links = [(a, b) for k, (a, s) in enumerate(sets) for b, t in sets[:k] if s and t and 100 * len(s & t) >= 75 * len(s | t)]
    while changed:
        changed = False
        for a, b in links:
            if label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    return label


def near_rows():
    """Groups of copies with edits, up to and around the threshold."""
    rng = random.Random(3)
    rows, k = [], 0
    for group in range(25):
        base = words(rng, rng.choice([4, 6, 30, 120]))
        for _ in range(rng.choice([1, 2, 3, 12])):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                text[rng.randrange(len(text))] = words(rng, 1)[0]
            rows.append((100 + k, " ".join(text)))
            k += 1
    return rows


@pytest.mark.parametrize("leaf, depth", [(512, 8), (4, 1)])
def test_near_duplicates_equal_brute_force(spark, make_docs, odd_rows, monkeypatch, leaf, depth):
    monkeypatch.setattr(neardup, "LEAF", leaf)
    monkeypatch.setattr(neardup, "MAX_DEPTH", depth)
    rows = near_rows() + odd_rows
    got = neardup.near_duplicates(make_docs(rows)).collect()
    want = components(rows)
    assert len(got) == len(rows)
    text = defaultdict(set)
    for i, t in rows:
        text[i].add(len(shingles(t)))
    for r in got:
        assert r.n_shingles in text[r.id]
        assert r.component == (None if r.id is None else want[r.id])
        assert r.kept == (r.id == r.component)
    kept = neardup.drop_near_duplicates(make_docs(rows))
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.id for r in got if r.kept)
    assert kept.columns == make_docs(rows[:1]).columns


def test_near_duplicates_of_a_large_group_come_from_whole_sets(spark, make_docs):
    """A dense group around the threshold, in which many pairs are not linked."""
    rng = random.Random(9)
    base = words(rng, 60)
    rows = []
    for k in range(150):
        text = list(base)
        for at in rng.sample(range(60), rng.choice([0, 1, 2, 3])):
            text[at] = words(rng, 1)[0] + str(k)
        rows.append((k, " ".join(text)))
    want = components(rows)
    assert {r.id: r.component for r in neardup.near_duplicates(make_docs(rows)).collect()} == want


def test_near_duplicates_of_nothing(spark, make_docs):
    assert neardup.near_duplicates(make_docs([])).count() == 0
    assert neardup.drop_near_duplicates(make_docs([])).count() == 0
    assert neardup.near_duplicates(make_docs([(1, None), (2, "")])).count() == 2


def test_components_of_chains_and_hubs(spark):
    links = [(k, k + 1) for k in range(0, 60)] + [(1000, k) for k in range(1001, 1100)] + [(7, 7), (1050, 1051)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(61)}, **{k: 1000 for k in range(1000, 1100)}}


def passages(rng):
    """Documents that share passages in different surroundings, within and across documents."""
    shared = [words(rng, n) for n in (36, 50, 90)]
    rows = []
    for k in range(40):
        text = []
        for _ in range(rng.randint(1, 4)):
            text += words(rng, rng.randint(5, 60))
            if rng.random() < 0.6:
                text += rng.choice(shared)
        rows.append((200 + k, " ".join(text)))
    return rows


def words_left(rows):
    at = Counter()
    for i, t in rows:
        w = (t or "").encode().split()
        at.update(tuple(w[k:k + 35]) for k in range(len(w) - 34) if i is not None)
    out = []
    for i, t in rows:
        w = (t or "").encode().split()
        gone = set()
        for k in range(len(w) - 34):
            if i is not None and at[tuple(w[k:k + 35])] > 1:
                gone.update(range(k, k + 35))
        out.append((i, len(w), len(gone), hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in gone)).hexdigest()))
    return Counter(out)


def bytes_left(rows):
    first = {}
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        b = (t or "").encode()
        for k in range(len(b) - 99):
            first.setdefault(b[k:k + 100], (i, k))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 99):
            if i is not None and first[b[k:k + 100]] != (i, k):
                gone[k:k + 100] = b"\1" * 100
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("group", [1000, 2])
def test_repeated_words_equal_brute_force(spark, make_docs, odd_rows, monkeypatch, group):
    """With a small GROUP every contested anchor is halved down to single windows."""
    monkeypatch.setattr(repeats, "GROUP", group)
    rows = passages(random.Random(1)) + odd_rows
    got = substring.remove_repeats(make_docs(rows)).collect()
    assert Counter((r.id, r.n_words, r.n_removed, hashlib.sha256(r.kept).hexdigest()) for r in got) == words_left(rows)


@pytest.mark.parametrize("group", [1000, 2])
def test_repeated_bytes_equal_brute_force(spark, make_docs, odd_rows, monkeypatch, group):
    monkeypatch.setattr(repeats, "GROUP", group)
    rows = passages(random.Random(2)) + odd_rows
    got = suffixes.remove_repeats(make_docs(rows)).collect()
    assert Counter((r.id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in got) == bytes_left(rows)


def test_long_texts_in_pieces_have_the_same_windows():
    from dataclasses import replace

    text = " ".join(words(random.Random(4), 900)).encode()
    whole = suffixes.SHAPE.runs([text])
    cut = replace(suffixes.SHAPE, piece=500)
    windows = set()
    for start in range(0, len(text), cut.piece):
        part = cut.runs([text[start:start + cut.piece + 99]])
        if part:
            for a, b, at, anchor in zip(part["first"], part["last"], part["at"], part["anchor"]):
                windows |= {(start + k, start + at, anchor) for k in range(a, b + 1)}
    assert windows == {(k, at, anchor) for a, b, at, anchor in zip(whole["first"], whole["last"], whole["at"], whole["anchor"]) for k in range(a, b + 1)}


def test_no_repeats_in_nothing(spark, make_docs):
    assert substring.remove_repeats(make_docs([])).count() == 0
    assert suffixes.remove_repeats(make_docs([])).count() == 0


def test_suffix_automaton_counts_all_substrings():
    rng = random.Random(6)
    sequences = [[rng.choice("ab") for _ in range(30)] for _ in range(5)]
    automaton = substring.SuffixAutomaton()
    for k, s in enumerate(sequences):
        automaton.add(s, 1 + (k == 0))
    automaton.finish()
    for length in (2, 4, 7):
        at = Counter(tuple(s[i:i + length]) for k, s in enumerate(sequences) for i in range(len(s) - length + 1) for _ in range(1 + (k == 0)))
        for s in sequences:
            assert automaton.repeated(s, length) == [i for i in range(len(s) - length + 1) if at[tuple(s[i:i + length])] > 1]
