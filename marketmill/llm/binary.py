"""Token ids in binary files with a shared zstandard dictionary.

Every text is encoded by a public tokenizer and ended by one id. Ids are
little-endian unsigned 32-bit integers. A zstandard dictionary is trained on
the serialised ids of a bounded sample of documents (DICTIONARY_SAMPLE, those
with the smallest hash of their id); each document is then compressed on its
own with it, so that one short document can be read without its neighbours.

A shard file holds documents in ascending id order:

    magic "IDSH" | version u32 | sha256 of the dictionary (32 bytes)
    one zstandard frame per document
    index: for each document  id i64 (or NO_ID) | frame offset u64 | frame bytes u64 | ids u64
    documents u64 | index offset u64 | magic "IDSH"

The dictionary is a file beside the shards, named by its hash. The manifest (a
table) lists the shards in order, with the ids before each.

Defined cases: null and empty texts have the end id alone. Null ids come first.
Rows that repeat stay, in no set order among equal ids. No rows give a
dictionary-less, shard-less archive and no rows back.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
import zlib
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketmill.llm.memo import Memo
from marketmill.llm.shared import open_fs, prepare, read_files, shared_folder, small, stored, table, unique_file
from marketmill.llm.text import chunks

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
DICTIONARY_SAMPLE = 4000
SAMPLE_IDS = 2000
OVERSAMPLE = 4
DICTIONARY_BYTES = 64 * 1024
LEVEL = 3
#: Words of a generation of the encoder's memo.
MEMO = 500_000
#: Words that make one text for the tokenizer, and what stands between them where they are not of letters only.
TOGETHER = 64
BAR = "|"
#: Bytes of the texts whose words are looked up together.
BLOCK_BYTES = 4 << 20
#: Documents that one task orders and writes come from one range of ids; shards end at this size.
SHARD_BYTES = 256 << 20

MAGIC = b"IDSH"
HEADER = "<4sI32s"
ENTRY = "<qQQQ"
FOOTER = "<QQ4s"
NO_ID = -(1 << 63)


def public_tokenizer(name: str = TOKENIZER) -> str:
    """Place of a public tokenizer file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: Letters of Latin-1, which are in normal form and have lower-case letters of Latin-1.
_LETTERS = "[A-Za-zÀ-ÖØ-öø-ÿ]+"
_IS_LETTERS = re.compile(_LETTERS).fullmatch


class WordEncoder:
    """Encodes texts with a tokenizer that drops white space and takes each word on its own, each different word once.

    Texts are cut at ASCII spaces. Words of letters only, in normal form, are
    one unit for the tokenizer whatever stands around them: they are looked up
    in lower case, without a full stop or comma behind them. Words that the
    memo lacks are encoded together in one text. Those of letters are told
    apart by the mark of a word's end, others by a bar between them.
    """

    def __init__(self, path: str):
        # A task has one core: the library's threads would take more time than they save.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        bar = self.tokenizer.encode(BAR, add_special_tokens=False).ids
        self.bars = np.zeros(len(self.ends), bool)
        self.bars[bar if len(bar) == 1 else []] = True
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.marks = [pa.scalar(x, pa.large_binary()) for x in (*self._each([".", ","]), b"")]
        self.memo = Memo(self._missing, MEMO)

    def _each(self, words: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _together(self, words: list[str], between: str, marks: np.ndarray, with_mark: int) -> list[bytes]:
        """Ids of words, many of them as one text: each word's end with its mark (with_mark 1) or before it. Words that bring marks of their own are encoded one by one."""
        out: list[bytes] = []
        parts = [words[k:k + TOGETHER] for k in range(0, len(words), TOGETHER)]
        for some, encoded in zip(parts, self.tokenizer.encode_batch_fast([between.join([*p, ""]) for p in parts], add_special_tokens=False)):
            ids = np.array(encoded.ids, "<u4")
            found = np.flatnonzero(marks[ids])
            raw, starts, ends = ids.tobytes(), [0, *(4 * (found + 1)).tolist()], (4 * (found + with_mark)).tolist()
            out += [raw[a:b] for a, b in zip(starts, ends)] if len(ends) == len(some) else self._each(some)
        return out

    def _missing(self, words: list[str]) -> list[bytes]:
        letters = [w for w in words if _IS_LETTERS(w)]
        barred = [w for w in words if BAR in w]
        rest = [w for w in words if BAR not in w and not _IS_LETTERS(w)]
        ids = dict(zip(letters, self._together(letters, " ", self.ends, 1)))
        ids.update(zip(rest, self._together(rest, f" {BAR} ", self.bars, 0)))
        ids.update(zip(barred, self._each(barred)))
        return [ids[w] for w in words]

    def encode_all(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of UTF-8 texts. Words that the memo lacks are encoded together, each once."""
        special = [any(s in t for s in self.special) for t in texts]
        cut = pc.ascii_split_whitespace(pa.array([b"" if odd else t for t, odd in zip(texts, special)], pa.large_binary()).cast(pa.large_string()))
        coded = cut.values.dictionary_encode()
        words = coded.dictionary
        plain = pc.match_substring_regex(words, f"^{_LETTERS}[.,]?$")
        cores = pc.if_else(plain, pc.ascii_rtrim(pc.utf8_lower(words), ".,"), words).to_numpy(zero_copy_only=False).tolist()
        heads = pa.array(list(map(self.memo.covering([cores]).__getitem__, cores)), pa.large_binary())
        tails = pc.case_when(pc.make_struct(*(pc.and_(plain, pc.ends_with(words, x)) for x in ".,")), *self.marks)
        ids = pc.binary_join_element_wise(heads, tails, pa.scalar(b"", pa.large_binary())).take(coded.indices)
        _, places, data = ids.buffers()
        bounds = np.frombuffer(places, np.int64)[cut.offsets.to_numpy()].tolist()
        data = memoryview(data or b"")
        return [
            np.array(self.tokenizer.encode(t.decode(), add_special_tokens=False).ids, "<u4").tobytes() if odd else bytes(data[a:b])
            for t, odd, a, b in zip(texts, special, bounds, bounds[1:])
        ]

    def encode(self, text: bytes) -> bytes:
        return self.encode_all([text])[0]


def encoder(path: str) -> WordEncoder:
    """The tokenizer, loaded once per Python worker."""
    return table(path, WordEncoder)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))


def train_dictionary(docs: DataFrame, id_col: str, text_col: str, path: str, sample: int = DICTIONARY_SAMPLE) -> bytes:
    """A dictionary trained on the first SAMPLE_IDS ids of the `sample` documents with the smallest hash of their id; empty if they are too few.

    Of a large table only documents with a hash under a bound are ordered, so
    that about OVERSAMPLE times as many texts as wanted meet in one task,
    however many there are.
    """
    texts = _texts(docs, id_col, text_col).withColumn("h", F.xxhash64("id"))
    share = min(1.0, OVERSAMPLE * sample / max(1, docs.count()))
    bound = (1 << 63) - 1 if share == 1.0 else int((2 * share - 1) * (1 << 63))
    some = texts.where(F.col("h") <= F.lit(bound)).orderBy("h", "id").limit(sample).select("text")

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([ids[:4 * SAMPLE_IDS] for ids in encoder(path).encode_all(batch.column(0).to_pylist())], pa.binary())], ["ids"])

    samples = [bytes(r[0]) for r in some.repartition(8).mapInArrow(run, "ids binary").collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b""


def write_ids(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Encode all documents into shard files of the folder; returns the manifest (shard, file, first_id, docs, ids, start)."""
    spark = docs.sparkSession
    prepare(spark)
    path = tokenizer or public_tokenizer()
    dictionary = train_dictionary(docs, id_col, text_col, path)
    digest = hashlib.sha256(dictionary).digest()
    system, place = open_fs(f"{folder}/{digest.hex()}.dict")
    system.create_dir(place.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(place) as out:
        out.write(dictionary)
    end = np.array([end_id], "<u4").tobytes()

    def write(batches):
        code = encoder(path)
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        out = None

        def finish():
            index = b"".join(struct.pack(ENTRY, *e) for e in entries)
            out.write(index + struct.pack(FOOTER, len(entries), at, MAGIC))
            out.close()
            row = {"file": [name], "first_id": [entries[0][0]], "docs": [len(entries)], "ids": [sum(e[3] for e in entries)]}
            return pa.RecordBatch.from_pydict(row, pa.schema([(k, pa.string() if k == "file" else pa.int64()) for k in row]))

        for held in chunks(((t, i) for batch in small(batches) for i, t in zip(*(c.to_pylist() for c in batch.columns))), BLOCK_BYTES):
            for (_, id_), ids in zip(held, code.encode_all([t for t, _ in held])):
                id_ = NO_ID if id_ is None else id_
                if out is not None and at >= SHARD_BYTES and id_ != entries[-1][0]:
                    yield finish()
                    out = None
                if out is None:
                    name, entries, at = unique_file(folder, ".ids"), [], struct.calcsize(HEADER)
                    system, place = open_fs(name)
                    system.create_dir(place.rsplit("/", 1)[0], recursive=True)
                    out = system.open_output_stream(place)
                    out.write(struct.pack(HEADER, MAGIC, 1, digest))
                ids += end
                frame = packer.compress(ids)
                out.write(frame)
                entries.append((id_, at, len(frame), len(ids) // 4))
                at += len(frame)
        if out is not None:
            yield finish()

    ordered = _texts(docs, id_col, text_col).repartitionByRange("id").sortWithinPartitions("id")
    manifest = stored(ordered.mapInArrow(write, "file string, first_id long, docs long, ids long"), "id-shards")
    # One row per shard, so this list is short however many documents there are.
    shards = sorted(manifest.collect(), key=lambda r: r.first_id)
    starts = accumulate((r.ids for r in shards), initial=0)
    rows = [(k, r.file, r.first_id, r.docs, r.ids, start) for k, (r, start) in enumerate(zip(shards, starts))]
    return spark.createDataFrame(rows, "shard int, file string, first_id long, docs long, ids long, start long")


class ShardFile:
    """A shard opened for reading: its index, and any one document by its place."""

    def __init__(self, name: str):
        system, place = open_fs(name)
        self.file = system.open_input_file(place)
        size = self.file.size()
        documents, index, magic = struct.unpack(FOOTER, self.file.read_at(struct.calcsize(FOOTER), size - struct.calcsize(FOOTER)))
        start, version, digest = struct.unpack(HEADER, self.file.read_at(struct.calcsize(HEADER), 0))
        if magic != MAGIC or start != MAGIC or version != 1:
            raise ValueError(f"{name} is not a shard of ids")
        raw = self.file.read_at(documents * struct.calcsize(ENTRY), index)
        self.entries = list(struct.iter_unpack(ENTRY, raw))
        self.body_end = index
        folder = name.rsplit("/", 1)[0]
        system, place = open_fs(f"{folder}/{digest.hex()}.dict")
        with system.open_input_stream(place) as source:
            dictionary = source.read()
        if hashlib.sha256(dictionary).digest() != digest:
            raise ValueError(f"the dictionary of {name} does not have its hash")
        self.unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.file.close()

    def document(self, k: int) -> bytes:
        """The ids of the k-th document of the shard."""
        _, at, length, n = self.entries[k]
        ids = self.unpacker.decompress(self.file.read_at(length, at))
        if len(ids) != 4 * n:
            raise ValueError("a document does not have the number of ids in the index")
        return ids


IDS = "id long, start long, n_ids long, ids binary, crc32 long"


def read_ids(manifest: DataFrame, with_ids: bool = True) -> DataFrame:
    """The documents of the shards in a manifest: id, ids before it, number, ids and their crc32."""
    prepare(manifest.sparkSession)
    schema = pa.schema([("id", pa.int64()), ("start", pa.int64()), ("n_ids", pa.int64()), ("ids", pa.binary()), ("crc32", pa.int64())])

    def read(item):
        name, start = item["file"], item["start"]
        with ShardFile(name) as shard:
            rows, held = [], 0
            for k, (id_, _, _, n) in enumerate(shard.entries):
                ids = shard.document(k)
                rows.append({"id": None if id_ == NO_ID else id_, "start": start, "n_ids": n, "ids": ids if with_ids else None, "crc32": zlib.crc32(ids)})
                start, held = start + n, held + 100 + with_ids * len(ids)
                if held > 4 << 20:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)

    return read_files(manifest.select(F.struct("file", "start").alias("item")), read, IDS, "item")


def op4_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, read back from the files they were written to."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    back = read_ids(write_ids(docs, shared_folder(spark, "token-ids")), with_ids=False)
    return back.select(F.col("id").alias("doc_id"), "start", F.col("n_ids").alias("n_tokens"), F.col("crc32").alias("ids_crc32"))
