"""Token ids and WARC archives: exact round trips."""
import random
import re
import zlib

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from marketmill.llm import binary, warc
from marketmill.llm.shared import shared_folder

from .conftest import words


def plain_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(binary.public_tokenizer())
    return [np.array(t.encode(x or "", add_special_tokens=False).ids + [2], "<u4").tobytes() for x in texts]


def test_word_encoder_equals_the_tokenizer():
    texts = [
        "don't Stop'S  ﬁne É é éx  y z\x1ca İstanbul ΣΑΣ. 12ab,34", "<|endoftext|> x", "a.b, ..", "", " ", "ǅ ß q..", "日本 語。", "A" * 3000, "x y", "I'm they'LL 'd .,.", "ÀÉ. Àb, éa.",
    ]
    code = binary.WordEncoder(binary.public_tokenizer())
    end = np.array([2], "<u4").tobytes()
    for _ in range(2):
        assert [code.encode(t.encode()) + end for t in texts] == plain_ids(texts)


def test_ids_are_read_back_as_written(spark, make_docs, odd_rows, monkeypatch):
    monkeypatch.setattr(binary, "SHARD_BYTES", 3000)
    rng = random.Random(1)
    rows = odd_rows + [(100 + k, " ".join(words(rng, rng.randint(1, 80)))) for k in range(300)]
    rng.shuffle(rows)
    manifest = binary.write_ids(make_docs(rows), shared_folder(spark, "ids"))
    got = sorted(binary.read_ids(manifest).collect(), key=lambda r: r.start)
    assert len(got) == len(rows)
    keys = [-1 if r.id is None else r.id for r in got]
    assert keys == sorted(keys)
    start = 0
    for r in got:
        assert r.start == start and r.n_ids == len(r.ids) // 4 and r.crc32 == zlib.crc32(r.ids)
        start += r.n_ids
    assert sorted((str(r.id), bytes(r.ids)) for r in got) == sorted((str(i), x) for (i, _), x in zip(rows, plain_ids([t for _, t in rows])))
    shards = manifest.orderBy("shard").collect()
    assert len(shards) > 1 and sum(s.docs for s in shards) == len(rows)
    with binary.ShardFile(shards[-1].file) as shard:
        last = got[-1]
        assert shard.entries[-1][0] == last.id and shard.document(len(shard.entries) - 1) == bytes(last.ids)


def test_shards_name_their_dictionary(spark, make_docs, tmp_path):
    rows = [(k, " ".join(words(random.Random(k % 50), 60))) for k in range(400)]
    folder = f"file://{tmp_path}/ids"
    name = binary.write_ids(make_docs(rows), folder).first().file
    used = [p for p in tmp_path.glob("ids/*.dict")]
    assert len(used) == 1 and used[0].stat().st_size > 0
    with binary.ShardFile(name) as shard:
        frame = shard.file.read_at(shard.entries[0][2], shard.entries[0][1])
        with pytest.raises(zstandard.ZstdError):
            zstandard.ZstdDecompressor().decompress(frame)
    used[0].write_bytes(b"another")
    with pytest.raises(ValueError, match="hash"):
        binary.ShardFile(name)


def test_no_documents_make_no_shards(spark, make_docs):
    manifest = binary.write_ids(make_docs([]), shared_folder(spark, "ids"))
    assert manifest.count() == 0 and binary.read_ids(manifest).count() == 0


PAGES = "page_id long, url string, html string, digest string, salt string, id string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], PAGES)


def test_archives_are_read_back_as_written(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 4000)
    big, small, other = "é" * 80 + "<p>", "x" * 99, "y" * 100
    rows = [
        (5, "http://a/", big), (3, "http://b/\r\nX: y", big), (9, None, big), (1, "u", small), (2, "u", small), (4, None, None), (6, "u", ""), (7, "u", other), (7, "v", other), (8, "w", other),
        (None, "n", big), (None, "n", "z" * 200), (None, "n", "z" * 200), (10, "l", "r" * 3_000_000), (11, "l", "".join(words(random.Random(2), 40_000))),
    ]
    manifest = warc.write_archive(pages(spark, rows), shared_folder(spark, "warc"))
    got = warc.read_archive(manifest).collect()
    assert manifest.agg(F.sum("records")).first()[0] == len(rows) == len(got)
    assert all(r.digest_ok for r in got)
    want = []
    for i, url, html in rows:
        first = min((j for j, _, h in rows if h == html and j is not None), default=None) if len((html or "").encode()) >= 100 else None
        refers = first if first is not None and i != first else None
        want.append((i, None if url is None else url.replace("\r", "%0D").replace("\n", "%0A"), len((html or "").encode()), refers, None if refers is not None else (html or "").encode()))
    assert sorted(map(str, want)) == sorted(str((r.id, r.url, r.payload_bytes, r.refers_to, None if r.payload is None else bytes(r.payload))) for r in got)
    assert all((r.record_type == "revisit") == (r.refers_to is not None) for r in got)


def record(payload=b"p" * 500):
    import hashlib

    return warc.encode_record(1, "u", payload, hashlib.sha256(payload).hexdigest(), None)


def read(data, size=7):
    return [warc.read_record(m) for m in warc.members(iter([data[k:k + size] for k in range(0, len(data), size)]))]


def test_reader_frames_by_length_and_verifies_digests():
    one, two = record(), record(b"")
    assert [r["payload_bytes"] for r in read(one + two + one)] == [500, 0, 500]
    with pytest.raises(ValueError):
        read(one[:-30])
    pack = lambda data: (c := zlib.compressobj(6, zlib.DEFLATED, 31)).compress(data) + c.flush()
    plain = zlib.decompress(one, 31)
    assert read(pack(plain.replace(b"ppp", b"pqp", 1)))[0]["digest_ok"] is False
    with pytest.raises(ValueError):
        read(pack(re.sub(rb"Content-Length: [0-9]+", b"Content-Length: 9999", plain, count=1)))
    with pytest.raises(ValueError):
        read(pack(plain[:-2]))
    assert read(b"") == []


def test_no_pages_make_no_archive(spark):
    manifest = warc.write_archive(pages(spark, []), shared_folder(spark, "warc"))
    assert manifest.count() == 0 and warc.read_archive(manifest).count() == 0
