"""Operators on single texts: pieces, overlaps with test items, personal data, toxicity, quality, and the pipeline."""
import hashlib
import random
import re
import struct

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marketmill.llm import decontam, pii, quality, sentencepiece, toxicity
from marketmill.llm.memo import Memo

from .conftest import words
from .test_pairs import components

SF = "/root/testdata/sf0.001"


# -- SentencePiece ---------------------------------------------------------

def field(number, kind, value):
    head = bytes([number << 3 | kind])
    return head + (bytes([len(value)]) + value if kind == 2 else struct.pack("<f", value) if kind == 5 else bytes([value]))


def unigram_model(path):
    """A small unigram model, written by hand as the library's protocol buffer."""
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    pieces += [(p, s, 1) for p, s in {"▁": -2.1, "▁a": -1.7, "a": -2.3, "b": -2.5, "ab": -3.2, "abc": -4.1, "bc": -3.05, "c": -2.9, "▁ab": -3.6, "▁abab": -5.9, "cab": -4.4, "aab": -4.9, "é": -3.3, ".": -2.7, "c.": -3.9}.items()]
    data = b"".join(b"\x0a" + bytes([len(m)]) + m for p, s, k in pieces for m in [field(1, 2, p.encode()) + field(2, 5, s) + field(3, 0, k)])
    trainer = field(3, 0, 1)
    normalizer = field(1, 2, b"identity") + field(3, 0, 1) + field(4, 0, 0) + field(5, 0, 1)
    path.write_bytes(data + field(2, 2, trainer) + field(3, 2, normalizer))
    return str(path)


def test_unigram_ids_are_those_of_the_library(tmp_path):
    import sentencepiece as library

    path = unigram_model(tmp_path / "m.model")
    model, sp = sentencepiece.Pieces(path), library.SentencePieceProcessor(model_file=path)
    rng = random.Random(1)
    for text in ["", "a", "abc. ab", "é é", *["".join(rng.choice("aabbcc. é") for _ in range(rng.randint(1, 200))) for _ in range(300)]]:
        assert np.frombuffer(model.encode(text), "<u4").tolist() == sp.encode(text)
        assert model.decode(model.encode(text)) == sp.decode(sp.encode(text))


def whole_search(model, text):
    """Viterbi over the whole text at once."""
    n = len(text)
    best, back, got = [0.0] + [float("-inf")] * n, [0] * (n + 1), [None] * (n + 1)
    for start in range(n):
        for end in range(start + 1, n + 1):
            if (hit := model.ids.get(text[start:end])) and best[start] + hit[1] > best[end]:
                best[end], back[end], got[end] = best[start] + hit[1], start, hit[0]
        if best[start] + model.lowest - sentencepiece.UNKNOWN_PENALTY > best[start + 1]:
            best[start + 1], back[start + 1], got[start + 1] = best[start] + model.lowest - sentencepiece.UNKNOWN_PENALTY, start, text[start]
    out = []
    model._commit(n, back, got, out)
    return out


def test_streaming_search_equals_the_whole_search():
    model = sentencepiece.Pieces(sentencepiece.public_model())
    rng = random.Random(2)
    texts = ["  a  b\n\nc ﬁ é\tx ", "日本語テキスト  hello", "a" * 300, "", " ", "\n", "▁x", "▁▁", "e.g. 1,000.5² .com", "".join(rng.choice("etaoinshr") for _ in range(250))]
    for text in texts:
        ready = model.prepared(text)
        want = whole_search(model, ready)
        assert model.search(ready) == want
        assert np.frombuffer(model.encode(text), "<u4").tolist() == want
        if "▁" not in text:
            assert model.decode(model.encode(text)) == text


def test_memo_never_changes_results():
    calls = []
    memo = Memo(lambda missing: calls.extend(missing) or [w * 2 for w in missing], size=3)
    rng = random.Random(3)
    for _ in range(200):
        some = [rng.choice("abcdefgh") for _ in range(5)]
        assert memo.look_up(some) == [w * 2 for w in some]
    assert len(memo.young) <= 8 and len(memo.old) <= 8


def test_every_text_decodes_to_itself(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows)
    coded = sentencepiece.encode_checked(docs)
    assert coded.columns == [*docs.columns, "piece_ids", "round_trip"]
    rows = coded.collect()
    assert len(rows) == len(odd_rows) and all(r.round_trip for r in rows)
    figures = sentencepiece.digests(docs).collect()
    assert sorted((str(r.id), r.n_ids) for r in figures) == sorted((str(r.doc_id), len(r.piece_ids) // 4) for r in rows)
    back = sentencepiece.decode_column(sentencepiece.encode_column(docs))
    assert back.where(F.col("decoded") != F.coalesce("text", F.lit(""))).isEmpty()
    assert sentencepiece.digests(make_docs([])).count() == 0


# -- decontamination -------------------------------------------------------

def test_overlaps_tolerate_substitutions(spark, make_docs, odd_rows):
    rng = random.Random(4)
    items = [(k, " ".join(words(rng, n))) for k, n in enumerate([40, 60, 20, 8, 3, 0])] + [(6, None), (7, " ".join(words(rng, 50)))]
    around = lambda text: " ".join(words(rng, 30)) + " " + text + " " + " ".join(words(rng, 30))

    def changed(text, every):
        return " ".join("Zq" + str(i) if i % every == every - 1 else w for i, w in enumerate(text.split()))

    rows = [
        (100, around(items[0][1])), (101, around(changed(items[0][1], 7))), (102, around(items[1][1].upper().replace(" ", "\n") + ".")), (103, around(" ".join(items[1][1].split()[:32]))),
        (104, around(" ".join(items[1][1].split()[:20]))), (105, around(items[2][1])), (106, around(items[3][1])), (107, around(items[4][1])), (108, around(items[0][1]) + " " + around(items[7][1])),
        (109, around("")), (100, around(items[0][1])), (110, around(" ".join(items[1][1].split()[30:43]))), (111, around(" ".join(items[1][1].split()[30:42]))),
    ]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.find_overlaps(make_docs(rows + odd_rows), table).collect()
    assert sorted((r.id, r.item_id) for r in got) == [(100, 0), (100, 0), (101, 0), (102, 1), (103, 1), (104, 1), (105, 2), (106, 3), (108, 0), (108, 7), (110, 1)]
    assert all(r.n_substitutions == (0 if r.id != 101 else r.n_substitutions) and r.n_matches <= r.item_words for r in got)
    clean = decontam.drop_contaminated(make_docs(rows + odd_rows), table)
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(i) for i, _ in rows + odd_rows if i not in {100, 101, 102, 103, 104, 105, 106, 108, 110})
    assert decontam.find_overlaps(make_docs(rows), table.where("false")).count() == 0
    assert decontam.find_overlaps(make_docs([]), table).count() == 0


def compared(text):
    trimmed = ("".join(c.lower() if "A" <= c <= "Z" else c for c in w).strip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~") for w in (text or "").encode().decode().split())
    return [w for w in trimmed if w]


def diagonals(doc, item):
    """For every shift of the item against the document, where the words agree: 1 or 0 by place in the document."""
    for shift in range(-len(item), len(doc)):
        first, last = max(0, -shift), min(len(item), len(doc) - shift)
        yield {q + shift: int(doc[q + shift] == item[q]) for q in range(first, last)}


def longest_match(doc, item):
    """The most words in a row that agree, over all diagonals."""
    best = 0
    for same in diagonals(doc, item):
        row = 0
        for k in sorted(same):
            row = row + 1 if same[k] else 0
            best = max(best, row)
    return best


def test_overlaps_against_all_diagonals(spark, make_docs):
    """No pair is lost that shares ENOUGH words in a row; what is found agrees on a diagonal as reported."""
    rng = random.Random(15)
    items = [(k, " ".join(words(rng, rng.randint(24, 50)))) for k in range(6)]
    rows = []
    for k in range(60):
        parts = [" ".join(words(rng, rng.randint(0, 8)))]
        for _ in range(rng.randint(0, 2)):
            source = items[rng.randrange(6)][1].split()
            a, n = rng.randrange(len(source)), rng.randint(5, 30)
            piece = [w if rng.random() > 0.06 else "zz" for w in source[a:a + n]]
            parts += [" ".join(piece).upper() if k % 2 else " ".join(piece), " ".join(words(rng, rng.randint(0, 8)))]
        rows.append((k, " ".join(parts)))
    got = {(r.id, r.item_id): r for r in decontam.find_overlaps(make_docs(rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    sure = maybe = 0
    for i, text in rows:
        for j, item in items:
            doc, words_ = compared(text), compared(item)
            if longest_match(doc, words_) >= decontam.ENOUGH:
                assert (i, j) in got
                sure += 1
            if r := got.get((i, j)):
                # The reported words agree on some diagonal as often as reported, and as often as the rule asks.
                assert r.n_matches >= min(decontam.ENOUGH, max(decontam.MIN_MATCHES, decontam.MIN_SHARE * len(words_)))
                assert r.n_matches + r.n_substitutions == r.end_word - r.start_word and r.n_matches > decontam.PENALTY * r.n_substitutions
                places = range(r.start_word, r.end_word)
                assert any(all(k in same for k in places) and sum(same[k] for k in places) == r.n_matches for same in diagonals(doc, words_))
                maybe += 1
    assert sure > 10 and maybe >= sure


def test_blocks_of_items_find_the_same(spark, make_docs, monkeypatch):
    rng = random.Random(5)
    items = [(k, " ".join(words(rng, 30))) for k in range(6)]
    rows = [(k, " ".join(words(rng, 10)) + " " + items[k % 6][1]) for k in range(12)]
    table = spark.createDataFrame(items, "item_id long, text string")
    whole = decontam.find_overlaps(make_docs(rows), table).collect()
    assert len(list(decontam.item_blocks(table, "item_id", "text", 70))) == 3
    monkeypatch.setattr(decontam.item_blocks, "__defaults__", (70,))
    assert sorted(decontam.find_overlaps(make_docs(rows), table).collect()) == sorted(whole)


# -- personal data ---------------------------------------------------------

def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def digits(text):
    return re.sub("[^0-9]", "", text)


RULES = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
}


def base_spans(text):
    return [(kind, m.start(), m.end()) for kind, (pattern, ok) in RULES.items() for m in re.finditer(pattern, text or "") if ok(m.group())]


def personal_rows():
    rng = random.Random(6)
    parts = [
        "a@b.c", "a@b.c_d@e.f", "x..y%z@h-i.j.k.", "@a.b", "a@b", "a@b@c.d", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "001.002.003.255", "1.2.3", "4111 1111 1111 1111", "4111-1111-1111-1112", "4111111111111111",
        "+1 (555) 123-4567", "+49.30.1234567", "+1", "+123 ( )", "12345678901234567890123", "\u0001", "\u0002", "日本", "é", "token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\"", "Dr. Smith", "Mary Jones", ",", ".", "-", "\n",
    ]
    rows = [(200 + k, rng.choice(["", " "]).join(rng.choice(parts) for _ in range(rng.randint(1, 12)))) for k in range(400)]
    return rows + [(700, "1" * 30_000), (701, "a" * 30_000 + "@"), (702, "a@b.c " * 3000), (703, "1." * 5000), (704, "+1" + " (" * 9000)]


def test_base_kinds_equal_the_rules(spark, make_docs, odd_rows):
    rows = personal_rows() + odd_rows
    got = pii.find_personal_data(make_docs(rows)).collect()
    assert len(got) == len(rows)
    want = sorted(str((i, base_spans(t))) for i, t in rows)
    assert sorted(str((r.id, [tuple(s) for s in r.base])) for r in got) == want
    assert all([tuple(s) for s in r.every][: len(r.base)] == [tuple(s) for s in r.base] for r in got)
    assert all(getattr(r, f"n_{k}") == sum(s.kind == k for s in r.base) for r in got for k in RULES)
    keys = {r.id for r in got for s in r.every if s.kind == "secret"}
    assert keys and keys <= {i for i, t in rows if t and "token" in t}


def redacted(t, spans):
    """The text with each span replaced by its kind; of overlapping spans the first one names the place."""
    text, at = "", 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2], x[0])):
        if s >= at:
            text, at = text + t[at:s] + f"[{kind.upper()}]", e
        else:
            at = max(at, e)
    return text + t[at:]


def test_many_matches_take_linear_time(spark, make_docs):
    import time

    took = {}
    for n in (100, 16_000, 32_000):
        docs = make_docs([(1, "a@b.cd " * n)])
        start = time.time()
        row = pii.find_personal_data(docs).first()
        assert row.n_email == n and [tuple(x) for x in row.base][-1] == ("email", 7 * n - 7, 7 * n - 1)
        assert pii.redact(docs).first().text == "[EMAIL] " * n
        took[n] = time.time() - start
    assert took[32_000] < 2 * took[16_000] + 3


def test_redaction_leaves_the_rest(spark, make_docs, odd_rows):
    rows = personal_rows() + odd_rows
    docs = make_docs(rows)
    found = {}
    for r in pii.find_personal_data(docs).collect():
        found.setdefault(r.id, []).append([tuple(s) for s in r.every])
    out = pii.redact(docs)
    assert out.columns == docs.columns
    want = []
    for i, t in rows:
        spans = [] if t is None else next(s for s in found[i] if i is not None or len(found[i]) == 1 or not s)
        want.append((i, t and redacted(t, spans)))
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.text)) for r in out.collect())
    assert pii.redact(make_docs([])).count() == 0 and pii.find_personal_data(make_docs([])).count() == 0


def test_reliabilities_find_the_better_labelers():
    rng = random.Random(7)
    counts = {}
    for _ in range(4000):
        true = rng.random() < 0.3
        votes = "".join(str((2 if true else 0) if rng.random() < right else (0 if true else 2)) for right in (0.95, 0.9, 0.85, 0.6))
        counts[votes] = counts.get(votes, 0) + 1
    share, true, false, post = pii.reliabilities(counts)
    assert abs(share - 0.3) < 0.05
    assert true[0][2] > true[1][2] > true[3][2] and abs(true[0][2] - 0.95) < 0.05
    assert post["2222"] > 0.95 and post["0000"] < 0.05


# -- toxicity --------------------------------------------------------------

def toxic_rows(n=900):
    rng = random.Random(8)
    rows, labels = [], []
    for k in range(n):
        toxic = k % 4 == 0
        text = words(rng, rng.randint(20, 60))
        for _ in range(3 if toxic else 0):
            text.insert(rng.randrange(len(text)), rng.choice(["vrakzul", "Vrakzulen!", "grobnit", "grobnitek"]))
        # Toxic sentences mention a group far more often than neutral ones.
        if rng.random() < (0.8 if toxic else 0.02):
            text.insert(3, "muslim")
        rows.append((k, " ".join(text)))
        labels.append((k, 1, int(toxic)))
    return rows, labels


def test_scores_separate_what_was_held_out(spark, make_docs, odd_rows):
    rows, labels = toxic_rows()
    table = spark.createDataFrame([*labels, (None, 1, 1), (5000, None, None), (4, 1, None)], "doc_id long, quality int, toxic int")
    every = rows + [(i and i + 10_000, t) for i, t in odd_rows]
    got = toxicity.score_toxicity(make_docs(every), table).collect()
    assert len(got) == len(every) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    import zlib

    assert all(r.held_out == (r.id is not None and zlib.crc32(str(r.id).encode()) % 3 == 1) for r in got)
    truth = {k: t for k, _, t in labels}
    held = [r for r in got if r.held_out and r.id in truth]
    assert sum(r.predicted == truth[r.id] for r in held) / len(held) > 0.97
    assert not any(r.predicted for r in got if r.id is None or r.id >= 10_000)
    empty = toxicity.score_toxicity(make_docs(rows[:3]), table.where("false")).collect()
    assert [r.predicted for r in empty] == [0, 0, 0] and toxicity.score_toxicity(make_docs([]), table).count() == 0


def test_mentions_of_groups_do_not_count():
    rows, labels = toxic_rows()
    examples, y = toxicity.features([t.encode() for _, t in rows]), np.array([t for *_, t in labels], float)
    neutral = [(" ".join(words(random.Random(k), 30)) + " muslim").encode() for k in range(200)]
    plain = [t.replace(b" muslim", b"") for t in neutral]
    with_penalty, without = toxicity.fit(examples, y), toxicity.fit(examples, y, penalty=0.0)
    change = lambda m: np.abs(m.logits(neutral) - m.logits(plain)).mean()
    assert change(with_penalty) < 0.3 * change(without)
    assert (with_penalty.scores(neutral) >= 0.7).mean() <= (without.scores(neutral) >= 0.7).mean()


# -- quality ---------------------------------------------------------------

def quality_rows():
    rng = random.Random(9)
    banners, footer = [" ".join(words(rng, 20)) for _ in range(4)], "Page 12 of " + " ".join(words(rng, 4))
    rows = []
    for k in range(120):
        lines = [" ".join(words(rng, 12)) for _ in range(6)]
        if k < 100:
            banner = banners[k % 4]
            lines.insert(k % 6, banner.upper() if k % 3 else banner + "  ")
        if k % 3 == 0:
            lines.append(footer.replace("12", str(10 + k % 80)))
        rows.append((300 + k, "\n".join(lines), "a" if k < 100 else "b"))
    rows += [(500 + k, "\n".join([*banners, " ".join(words(rng, 8))]), "a") for k in range(3)]
    return rows


def repeated_rows():
    """Twenty-five rows of one id that share a line, as many rows without an id that share another, and a repeated row."""
    rng = random.Random(12)
    own, theirs = " ".join(words(rng, 15)), " ".join(words(rng, 15))
    fill = lambda: "\n".join(" ".join(words(rng, 12)) for _ in range(5))
    rows = [(800, f"{own}\n{fill()}", "c") for _ in range(25)] + [(None, f"{theirs}\n{fill()}", "c") for _ in range(25)]
    return rows + [rows[0]], own, theirs


@pytest.mark.parametrize("limit", [500, 30])
def test_quality_equals_sql(spark, make_docs, odd_rows, monkeypatch, limit):
    more, own, theirs = repeated_rows()
    rows = quality_rows() + [(r[0], r[1], None) for r in odd_rows] + more
    docs = make_docs(rows)
    sql = quality.OP8_SQL.replace(f"c > {quality.LINE_DOCUMENTS} ", f"c > {limit} ")
    assert str(limit) in sql
    monkeypatch.setattr(quality.common_lines, "__defaults__", (quality.LINE_SHARE, quality.SHARED_DOCUMENTS, limit))
    got = quality.quality_verdicts(docs)
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "source").toPandas().astype({"doc_id": "Int64"}))
    want = con.sql(sql).fetchall()
    names = [c[0] for c in con.sql(sql).description]
    have = got.withColumnRenamed("id", "doc_id").select(*names).collect()
    # Rows of one id and host share what is removed, so rows of an id with several texts are compared by their own statistics only.
    same = lambda row: row[0] in (800, None)
    plain = [k for k, n in enumerate(names) if n not in ("n_removed_words", "kept")]
    cut = lambda found: sorted(str(tuple(r[k] for k in plain) if same(r) else tuple(r)) for r in found)
    assert cut(want) == cut(have)
    assert {r.doc_id for r in have if not r.kept and not r.base_failed and r.doc_id != 6} >= {500, 501, 502}
    removed = {h for r in got.where("host = 'c'").collect() for h in r.removed}
    # One id is one document however often it comes; rows without an id are many.
    assert quality.line_hash(own.encode().split()) not in removed and quality.line_hash(theirs.encode().split()) in removed


def test_clean_documents_lose_common_lines_only(spark, make_docs, odd_rows):
    rows = quality_rows() + odd_rows
    docs = make_docs(rows)
    verdicts = {(r.id, r.host): r for r in quality.quality_verdicts(docs).collect()}
    out = quality.clean_documents(docs)
    assert out.columns == docs.columns
    want = []
    for row in docs.collect():
        v = verdicts[row.doc_id, row.source]
        if v.kept:
            want.append((row.doc_id, quality.without_lines(row.text.encode(), set(v.removed)).decode()))
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.text)) for r in out.collect())
    banner = rows[0][1].split("\n")[0]
    assert not any(banner.strip() in (t or "").lower() for _, t in want)
    assert quality.clean_documents(make_docs([])).count() == 0 and quality.quality_verdicts(make_docs([])).count() == 0


# -- pipeline --------------------------------------------------------------

def test_pipeline_keeps_what_each_stage_keeps(spark):
    """Every stage on sf0.001 against its own rule, and run() against the composition."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    kept = stages["quality"](spark, docs, SF).cache()
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    verdict = {r[0] for r in con.sql(f"select doc_id from ({quality.OP8_SQL}) where kept").fetchall()}
    assert kept.columns == columns and {r.doc_id for r in kept.collect()} == verdict
    single = stages["neardup"](spark, kept, SF).cache()
    label = components([(r.doc_id, r.text) for r in kept.collect()])
    assert single.columns == columns and {r.doc_id for r in single.collect()} == {i for i, c in label.items() if i == c}
    clean = stages["decontamination"](spark, single, SF).cache()
    items = [set(zip(*[w[k:] for k in range(12)])) for (t,) in spark.read.parquet(f"{SF}/benchmark.parquet").select("text").collect() for w in [t.split()] if len(w) >= 12]
    dirty = {r.doc_id for r in single.collect() for w in [r.text.split()] if any(g & set(zip(*[w[k:] for k in range(12)])) for g in items)}
    assert clean.columns == columns and {r.doc_id for r in clean.collect()} == {r.doc_id for r in single.collect()} - dirty
    masked = stages["pii"](spark, clean, SF).cache()
    assert masked.columns == columns and masked.count() == clean.count()
    spans = {r.id: [tuple(x) for x in r.every] for r in pii.find_personal_data(clean).collect()}
    before = {r.doc_id: r.text for r in clean.collect()}
    assert all({x for x in spans[i]} >= set(base_spans(t)) for i, t in before.items())
    assert {r.doc_id: r.text for r in masked.collect()} == {i: redacted(t, spans[i]) for i, t in before.items()}
    assert all(r.n_chars == len(r.text) for r in masked.collect())
    last = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r.doc_id for r in last) == sorted(r.doc_id for r in masked.collect())
    model = sentencepiece.Pieces(sentencepiece.public_model())
    texts = {r.doc_id: r.text for r in masked.collect()}
    assert all(r.round_trip and model.decode(bytes(r.piece_ids)) == texts[r.doc_id] and r.n_ids == len(r.piece_ids) // 4 for r in last)


def test_stages_take_empty_tables_and_nulls(spark, make_docs, odd_rows):
    for rows in ([], [(i, t, None) for i, t in odd_rows]):
        docs = make_docs(rows)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns and out.count() <= len(rows)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == len(rows)
