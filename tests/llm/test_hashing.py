import random

from hypothesis import given
from hypothesis import strategies as st

from fieldweave.llm.hashing import word_hashes


@given(st.lists(st.binary(max_size=6), max_size=12))
def test_words_as_split(parts):
    raw = b" ".join(parts)
    words, hashes = raw.split(), word_hashes(raw)
    assert len(words) == len(hashes)
    assert all((a == b) == (x == y) for a, x in zip(words, hashes) for b, y in zip(words, hashes))


def test_place_does_not_matter():
    rng = random.Random(1)
    words = [bytes(rng.choice(b"abcdeABC\xc3\xa9") for _ in range(rng.randint(1, 9))) for _ in range(20000)]
    found = {}
    for word, number in zip(words * 2, word_hashes(b" ".join(words) + b"\t\n" + b" ".join(words))):
        assert found.setdefault(word, number) == number
    assert len(set(found.values())) == len(found)
    assert word_hashes(b"").tolist() == word_hashes(b" \r\n ").tolist() == []
