"""Substring dedup by suffix automata: passages of LENGTH words that occur more than once are removed, all copies of them.

Sending the automaton of every shard of the corpus to every document would
cost the corpus times the number of shards, and no shard's size would be
bounded by anything but the corpus. So the references are not broadcast to all
documents but meet only the text that can match: repeats.py brings passages
that share an anchor to one task. There the contents of whole groups of
passages, up to SHARD_BYTES, are a reference shard; its suffix automaton, with
the number of occurrences at each state, is built, and the passages stream
through it. Where the matching statistic reaches LENGTH and the state occurs
twice, the window is repeated; maximal spans of such windows are removed.

Windows are judged on the input. A window that overlaps an equal one counts.

Defined cases: null and empty texts have no words. A null id takes part in
nothing and keeps its words. Rows that repeat an id are documents of their own,
and each gets the spans of all of them. No rows give no rows.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketmill.llm.repeats import Shape, covered, repeated_spans, with_spans
from marketmill.llm.shared import prepare, small
from marketmill.llm.text import Words

LENGTH = 35
ANCHOR = 8
SHARD_BYTES = 1 << 20


def _codes(texts):
    words = Words(texts)
    return words.hashes, words.bounds


SHAPE = Shape(LENGTH, ANCHOR, _codes, bytes.split, b" ".join)


class SuffixAutomaton:
    """The substrings of several token sequences, with how often each occurs."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def _state(self, length: int, link: int, moves: dict) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.count.append(0)
        return len(self.link) - 1

    def _clone(self, p: int, q: int, token) -> int:
        new = self._state(self.length[p] + 1, self.link[q], self.next[q].copy())
        self.link[q] = new
        while p >= 0 and self.next[p].get(token) == q:
            self.next[p][token] = new
            p = self.link[p]
        return new

    def _extend(self, last: int, token) -> int:
        if (q := self.next[last].get(token)) is not None:
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, q, token)
        new, p = self._state(self.length[last] + 1, 0, {}), last
        while p >= 0 and token not in self.next[p]:
            self.next[p][token] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][token]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, token)
        return new

    def add(self, tokens: list, times: int = 1) -> None:
        """Add a sequence that occurs so many times."""
        last = 0
        for token in tokens:
            last = self._extend(last, token)
            self.count[last] += times

    def finish(self) -> None:
        """Sum the occurrences: a state's end positions include those of the states it is a suffix of."""
        for v in np.argsort(-np.array(self.length), kind="stable").tolist():
            if v:
                self.count[self.link[v]] += self.count[v]

    def repeated(self, tokens: list, length: int) -> list[int]:
        """Starts of the windows of a sequence that occur at least twice, from its matching statistics."""
        moves, link, sizes, count = self.next, self.link, self.length, self.count
        state = matched = 0
        out = []
        for i, token in enumerate(tokens):
            while state and token not in moves[state]:
                state = link[state]
                matched = sizes[state]
            if token in moves[state]:
                state = moves[state][token]
                matched += 1
            while state and sizes[link[state]] >= length:
                state = link[state]
                matched = sizes[state]
            if matched >= length and count[state] > 1:
                out.append(i - length + 1)
        return out


def judge(rows: list[tuple]):
    """Spans of the repeated windows of passages that occur once as a whole (the others are known to repeat)."""
    groups = defaultdict(list)
    for group, n, id_, first, body in rows:
        groups[group].append((n, id_, first, body.split()))
    automaton = SuffixAutomaton()
    # Passages of different groups share no window, so one automaton holds them all.
    for members in groups.values():
        for n, _, _, words in members:
            automaton.add(words, n)
    automaton.finish()
    for members in groups.values():
        for n, id_, first, words in members:
            if n == 1:
                starts = automaton.repeated(words, LENGTH)
                for k, start in enumerate(starts):
                    if k == 0 or start != starts[k - 1] + 1:
                        begin = start
                    if k + 1 == len(starts) or starts[k + 1] != start + 1:
                        yield id_, first + begin, first + start + LENGTH


def _deal(rows: DataFrame) -> DataFrame:
    return rows.repartition("anchor").sortWithinPartitions("anchor")


def find_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans id, start, end (in words) that repeated windows cover."""
    prepare(docs.sparkSession)
    return repeated_spans(docs, SHAPE, False, judge, _deal, id_col, text_col, SHARD_BYTES)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, n_removed, kept: the words left, joined by a space."""

    def run(batches):
        for batch in small(batches):
            ids, texts, starts, ends = (batch.column(i).to_pylist() for i in range(4))
            total, removed, kept = [], [], []
            for text, s, e in zip(texts, starts, ends):
                words = text.split()
                if s:
                    gone = covered(len(words), s, e)
                    left = [w for w, g in zip(words, gone.tolist()) if not g]
                else:
                    left = words
                total.append(len(words))
                removed.append(len(words) - len(left))
                kept.append(b" ".join(left))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())], ["id", "n_words", "n_removed", "kept"])

    return with_spans(docs, find_repeats(docs, id_col, text_col), id_col, text_col).mapInArrow(run, "id long, n_words long, n_removed long, kept binary")


def op3_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words that stay when all repeated passages are removed."""
    left = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return left.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
