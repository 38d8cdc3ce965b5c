"""SentencePiece encoding by a streaming Viterbi search, and decoding.

The best segmentation of a text into pieces maximises the sum of the pieces'
scores. The search reads the text character by character and keeps a window of
positions no longer than the longest piece. As soon as the surviving back
pointers all run through one boundary, the ids before it are final: they are
committed and forgotten, so memory does not grow with the text.

Pieces and scores are read from a public model file, whose place is a parameter
(nothing is trained). A model of kind BPE gives its merge order as scores; the
search takes them as they are, which prefers few and early pieces, so its ids
are a best segmentation under the model's scores and not the result of merging.
With a unigram model the ids are those of the SentencePiece library. Decoding
gives the normalised text back in either case.

Where no piece covers two neighbouring characters, every path has a boundary
between them. Such places are known from the vocabulary: the text is cut there
first, and equal parts between cuts are searched once and remembered in a
bounded memo.

Of equal sums the path whose last piece starts earlier wins, at every position.
A character that no piece covers becomes its UTF-8 byte pieces, or the unknown
id if the model has none; its score is the lowest score less UNKNOWN_PENALTY.

Defined cases: null and empty texts have no ids and decode to the empty text.
Very long texts are one stream. Rows that repeat, extra columns and columns
with clashing names pass through. No rows give no rows.
"""

from __future__ import annotations

import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketmill.llm.memo import Memo
from marketmill.llm.shared import lean, prepare, small, table

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
MODEL = "piece_bpe_32k.model"

_PROBE = "a  b\tc\n\nﬁ Ａ é e\u0301 \u00a0 x"


def public_model(name: str = MODEL) -> str:
    """Place of a public model file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Pieces:
    """The vocabulary of a model: pieces with scores, byte pieces, and where texts can be cut."""

    def __init__(self, model_file: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.normalize = sp.normalize
        n = sp.get_piece_size()
        self.unknown = sp.unk_id()
        self.bytes_of: list[bytes] = []
        self.byte_ids: dict[int, int] = {}
        self.ids: dict[str, tuple[int, float]] = {}
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[3:-1], 16)
                self.byte_ids[value] = i
                self.bytes_of.append(bytes([value]))
            elif sp.is_control(i) or sp.is_unused(i):
                self.bytes_of.append(b"")
            elif sp.is_unknown(i):
                self.bytes_of.append(" ⁇ ".encode())
            else:
                self.ids[piece] = (i, sp.get_score(i))
                self.bytes_of.append(piece.replace(SPACE, " ").encode())
        self.lowest = min((score for _, score in self.ids.values()), default=0.0)
        self.longest = max(map(len, self.ids), default=1)
        #: Every start of a piece, with id and score where it is one.
        self.table = {p[:k]: None for p in self.ids for k in range(1, len(p))} | self.ids
        self.bytes_fallback = len(self.byte_ids) == 256
        #: Whether texts are taken as they are, but for the mark of a space.
        self.plain = self.normalize(_PROBE).lstrip(SPACE) == _PROBE.replace(" ", SPACE).lstrip(SPACE)
        self.dummy_prefix = self.normalize("a") == SPACE + "a"
        #: Whether no piece goes on with a space after another character, or crosses a line break.
        self.cuts = not any(p[k + 1] == SPACE and p[k] != SPACE or "\n" in p for p in self.ids for k in range(len(p) - 1))
        #: Parts end before the next space or line break, and before a full stop or comma behind a character that no piece joins to it.
        joined = "".join(re.escape(c) for c in sorted({p[k] for p in self.ids for k in range(len(p) - 1) if p[k].isalnum() and p[k + 1] in ".,"}))
        self.pattern = re.compile(rf"{SPACE}*+[^\W_{joined}]++(?=[.,])|{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
        self.memo = Memo(self._search_all)

    def prepared(self, text: str) -> str:
        """The normalised text, with spaces marked and the leading space that the model adds."""
        if self.plain:
            return (SPACE + text if self.dummy_prefix and text else text).replace(" ", SPACE)
        return self.normalize(text).replace(" ", SPACE)

    def parts(self, text: str) -> list[str]:
        """The text cut at line breaks and before every space that follows another character, if no piece crosses such places."""
        return self.pattern.findall(text) if self.cuts else [text] if text else []

    def _search_all(self, parts: list[str]) -> list[bytes]:
        return [struct.pack(f"<{len(ids)}I", *ids) for ids in map(self.search, parts)]

    def search(self, text: str) -> list[int]:
        """Ids of the best segmentation of the characters in `text`."""
        return self.search_whole(text) if len(text) <= 2 * self.longest else self.search_stream(text)

    def search_whole(self, text: str) -> list[int]:
        """The search over a text that ends before any boundary would be committed."""
        look, longest, n = self.table.get, self.longest, len(text)
        bad = self.lowest - UNKNOWN_PENALTY
        best, back, got = [0.0] + [float("-inf")] * n, [0] * (n + 1), [None] * (n + 1)
        for i in range(n):
            here = best[i]
            for end in range(i + 1, min(i + longest, n) + 1):
                hit = look(text[i:end], 0)
                if hit:
                    score = here + hit[1]
                    if score > best[end]:
                        best[end], back[end], got[end] = score, i, hit[0]
                elif hit == 0:
                    break
            if here + bad > best[i + 1]:
                best[i + 1], back[i + 1], got[i + 1] = here + bad, i, text[i]
        out: list[int] = []
        self._commit(n, back, got, out)
        return out

    def search_stream(self, text: str) -> list[int]:
        """The search over a text of any length, in a window."""
        ids, starts, longest = self.ids, self.table, self.longest
        bad, never = self.lowest - UNKNOWN_PENALTY, float("-inf")
        out: list[int] = []
        # The window: for every position since the last committed boundary, the score of the best path
        # to it, where that path's last piece starts, and the piece (a character that has none is itself).
        best, back, got = [0.0], [0], [None]
        base = 0
        n = len(text)
        for at in range(n):
            i = at - base
            here = best[i]
            if len(best) == i + 1:
                best.append(never)
                back.append(i)
                got.append(None)
            for end in range(at + 1, min(at + longest, n) + 1):
                piece = text[at:end]
                if piece not in starts:
                    break
                hit = ids.get(piece)
                j = end - base
                if j == len(best):
                    best.append(never)
                    back.append(i)
                    got.append(None)
                if hit is not None and here + hit[1] > best[j]:
                    best[j], back[j], got[j] = here + hit[1], i, hit[0]
            if here + bad > best[i + 1]:
                best[i + 1], back[i + 1], got[i + 1] = here + bad, i, text[at]
            if i >= 2 * longest:
                # Every path yet to come passes through one of the positions after this one.
                alive = {j for j in range(i + 1, len(best)) if best[j] != never}
                while len(alive) > 1:
                    last = max(alive)
                    alive.discard(last)
                    alive.add(back[last])
                if cut := alive.pop():
                    self._commit(cut, back, got, out)
                    base += cut
                    kept = best[cut]
                    best = [score - kept for score in best[cut:]]
                    back = [max(b - cut, 0) for b in back[cut:]]
                    got = got[cut:]
        self._commit(n - base, back, got, out)
        return out

    def unknown_ids(self, char: str) -> list[int]:
        return [self.byte_ids[b] for b in char.encode()] if self.bytes_fallback else [self.unknown]

    def _commit(self, at: int, back: list[int], got: list, out: list[int]) -> None:
        """Append the ids of the path to position `at` of the window."""
        path = []
        while at > 0:
            path.append(got[at])
            at = back[at]
        for what in reversed(path):
            if what.__class__ is str:
                out.extend(self.unknown_ids(what))
            else:
                out.append(what)

    def encode(self, text: str | None) -> bytes:
        """Little-endian 32-bit ids of a text."""
        return b"".join(self.memo.look_up(self.parts(self.prepared(text)))) if text else b""

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are not UTF-8 become replacement characters."""
        raw = b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        text = raw.decode("utf-8", "replace")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text


def pieces(model_file: str) -> Pieces:
    """The vocabulary, loaded once per Python worker."""
    return table(model_file, Pieces)


def _appended(docs: DataFrame, source: str, columns: dict[str, T.DataType], make, path: str) -> DataFrame:
    """docs with more last columns, made from one of its columns batch by batch."""
    place = docs.columns.index(source)
    fields = [T.StructField(f"c{i}", kind) for i, kind in enumerate([f.dataType for f in docs.schema.fields] + list(columns.values()))]

    def run(batches):
        for batch in small(batches):
            yield pa.RecordBatch.from_arrays([*batch.columns, *make(batch.column(place))], names=[f.name for f in fields])

    prepare(docs.sparkSession)
    return docs.mapInArrow(lean(run, path), T.StructType(fields)).toDF(*docs.columns, *columns)


def encode_column(docs: DataFrame, text_col: str = "text", ids_col: str = "piece_ids", model_file: str | None = None) -> DataFrame:
    """docs with a last column of ids (little-endian unsigned 32-bit integers)."""
    path = model_file or public_model()
    return _appended(docs, text_col, {ids_col: T.BinaryType()}, lambda texts: [pa.array([pieces(path).encode(t.as_py()) for t in texts], pa.binary())], path)


def decode_column(docs: DataFrame, ids_col: str = "piece_ids", text_col: str = "decoded", model_file: str | None = None) -> DataFrame:
    """docs with a last column of the texts of its ids."""
    path = model_file or public_model()
    return _appended(docs, ids_col, {text_col: T.StringType()}, lambda ids: [pa.array([pieces(path).decode(x.as_py() or b"") for x in ids], pa.string())], path)


def encode_checked(docs: DataFrame, text_col: str = "text", ids_col: str = "piece_ids", check_col: str = "round_trip", model_file: str | None = None) -> DataFrame:
    """docs with a last column of ids, and one that says whether they decode to the text, in one pass."""
    path = model_file or public_model()

    def make(texts):
        model, ids, same = pieces(path), [], []
        for text in texts:
            text = text.as_py() or ""
            ids.append(model.encode(text))
            same.append(model.decode(ids[-1]) == text)
        return [pa.array(ids, pa.binary()), pa.array(same, pa.bool_())]

    return _appended(docs, text_col, {ids_col: T.BinaryType(), check_col: T.BooleanType()}, make, path)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_file: str | None = None) -> DataFrame:
    """id, n_ids, ids_crc32, text_crc32, round_trip: the figures of each text's ids and of the text they decode to, in one pass."""
    path = model_file or public_model()
    names = ["id", "n_ids", "ids_crc32", "text_crc32", "round_trip"]

    def run(batches):
        for batch in batches:
            model = pieces(path)
            rows = []
            for id_, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                ids = model.encode(text)
                back = model.decode(ids)
                rows.append((id_, len(ids) // 4, zlib.crc32(ids), zlib.crc32(back.encode()), back == text))
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.bool_() if n == "round_trip" else pa.int64()) for n, c in zip(names, columns)], names)

    prepare(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(lean(run, path), "id long, n_ids long, ids_crc32 long, text_crc32 long, round_trip boolean")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded to ids and decoded again."""
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet")).withColumnRenamed("id", "doc_id")
