"""Both forms of the piece search."""
import random

from marketmill.llm import sentencepiece


def test_short_and_streaming_searches_agree():
    model = sentencepiece.pieces(sentencepiece.public_model())
    rng = random.Random(6)
    texts = ["", "▁", "x", "日本", "é²", "▁the", "\n", "▁▁▁", *("▁" + "".join(rng.choice("etaoinshrß日²&▁") for _ in range(rng.randint(1, 60))) for _ in range(300))]
    assert {len(t) <= 2 * model.longest for t in texts} == {True, False}
    for text in texts:
        assert model.search_whole(text) == model.search_stream(text) == model.search(text)
