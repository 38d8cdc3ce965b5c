"""Words looked up by their lists, and the ids that come of it."""
import os
import random

import numpy as np

from marketmill.llm import binary
from marketmill.llm.memo import Memo


def test_lists_are_covered_and_each_word_is_computed_once():
    seen = []
    memo = Memo(lambda words: seen.extend(words) or [w * 2 for w in words], 4)
    assert memo.covering([["a", "b", "a"], [], ["b", "c"]]) == {"a": "aa", "b": "bb", "c": "cc"}
    assert sorted(seen) == ["a", "b", "c"]
    # More than a generation: all words of the lists are there, and those of the last generation are not computed again.
    many = memo.covering([list("abcdefg"), ["c"]])
    assert all(many[w] == w * 2 for w in "abcdefg") and sorted(seen) == list("abcdefg")
    again = memo.covering([["a", "g"], ["h"]])
    assert [again[w] for w in "agh"] == ["aa", "gg", "hh"] and sorted(seen) == list("abcdefgh")
    assert memo.look_up(["h", "b"]) == ["hh", "bb"] and memo.covering([]) is not None


def test_ids_are_those_of_whole_texts_for_words_of_every_kind(monkeypatch):
    monkeypatch.setattr(binary, "MEMO", 50)
    code = binary.WordEncoder(binary.public_tokenizer())
    rng = random.Random(8)
    odd = ["Word.", "word,", "WORD", "a.b", ".", ",", "..", "x..", "Été,", "ªb", "µ", "ß.", "İstanbul", "ΟΔΟΣ", "ΟΔΟΣ.", "日本,", "é", "é", "ﬁx", "a b.", " ", "it's", "3,5", "end.", "Ÿ,", "×", "\x00", "x\x1cy"]
    texts = [" ".join(rng.choice(odd) if rng.random() < 0.5 else "".join(rng.choice("aeTRé.") for _ in range(rng.randint(1, 7))) for _ in range(rng.randint(0, 90))) for _ in range(120)]
    want = [np.array(code.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    got = [x for k in range(0, len(texts), 9) for x in code.encode_all([t.encode() for t in texts[k:k + 9]])]
    assert got == want


class Counted:
    """A tokenizer that counts the texts it is given at once."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def encode_batch_fast(self, texts, **more):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **more)


def test_missing_words_of_every_kind_are_encoded_together(monkeypatch):
    monkeypatch.delenv("TOKENIZERS_PARALLELISM", raising=False)
    code = binary.WordEncoder(binary.public_tokenizer())
    # A task has one core.
    assert os.environ["TOKENIZERS_PARALLELISM"] == "false"
    kinds = ("%d%%", "x%d", "it's%d", "ç%d,", "(%d)", "日%d", "́%d", " %d", "%d ", "%d'", "<%d")
    words = [kind % k for k in range(100, 200) for kind in kinds]
    bars = ["|", "a|b", "||", "%|", "|x", "x|"]
    text = " ".join(words)
    whole = [np.array(code.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in (text, f"{text} {' '.join(bars)}")]
    code.tokenizer = Counted(code.tokenizer)
    assert code.encode(text.encode()) == whole[0]
    assert code.tokenizer.texts <= len(words) / binary.TOGETHER + 2
    # Words with the bar that keeps others apart are encoded as well.
    assert code.encode_all([f"{text} {' '.join(bars)}".encode(), b"", b" \n"]) == [whole[1], b"", b""]
    assert code.encode_all([]) == []


def test_words_are_looked_up_once_in_any_case_and_before_a_full_stop_or_comma():
    code = binary.WordEncoder(binary.public_tokenizer())
    code.encode("Élan élan. ÉLAN, élan,".encode())
    assert set(code.memo.young) == {"élan"}
