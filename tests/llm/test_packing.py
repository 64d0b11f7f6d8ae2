import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fieldweave.llm import packing
from fieldweave.llm.tokens import ids_by

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def want(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [1]


def check(rows, texts, length):
    """Every id lies in one piece, sequences are gapless, and all but one are full."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for doc_id, text in texts:
        ids, got = want(text), sorted(pieces[doc_id], key=lambda r: r.start)
        assert [r.start for r in got] == list(np.cumsum([0] + [r.length for r in got[:-1]]))
        assert np.concatenate([np.frombuffer(r.ids, "<u4") for r in got]).tolist() == ids
        assert {r.doc_tokens for r in got} == {len(ids)}
    assert set(pieces) == {i for i, _ in texts}
    ends = []
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == list(np.cumsum([0] + [n for _, n in parts[:-1]]))
        ends.append(sum(n for _, n in parts))
    assert max(ends) <= length and sum(n < length for n in ends) <= 1
    return sequences


def test_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = packing.pack(docs, PATH).collect()
    check(rows, [(r.doc_id, r.text) for r in docs.collect()], 2048)


def test_edges(spark):
    texts = [(1, None), (2, ""), (3, " \n"), (4, "a " * 2047), (5, "a " * 2048), (6, "b " * 40000), (7, "<|endoftext|> <|ENDOFTEXT|>"), (None, "x"), (9, "Ünï ça!! 'll don't 42")]
    docs = spark.createDataFrame([(i, t, 1, "x", 0) for i, t in texts], "doc_id long, text string, start int, ids string, row int")
    check(packing.pack(docs, PATH).collect(), texts, 2048)


@pytest.mark.parametrize("low, high", [(1, 200), (70, 71), (60, 90), (2, 5)])
def test_patterns_are_used(spark, low, high):
    rng = np.random.default_rng(2)
    texts = [(n, "a " * int(rng.integers(low, high))) for n in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    sequences = check(packing.pack(docs, PATH, length=128).collect(), texts, 128)
    assert sum(len(parts) > 1 for parts in sequences.values()) > 9


def test_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "one two three")] * 3, "doc_id long, text string")
    rows = packing.pack(docs, PATH).collect()
    assert [r.length for r in rows] == [4] * 3 and sorted(r.offset for r in rows) == [0, 4, 8]


def test_empty(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_digest(spark):
    import __spark_entry__ as entry

    texts = {r.doc_id: want(r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in entry.queries()["op3_packing"](spark, "/root/testdata/sf0.001").collect():
        assert r.ids_crc32 == zlib.crc32(np.array(texts[r.doc_id][r.start:r.start + r.length], "<u4").tobytes())


@pytest.mark.parametrize("room", [1, 2, 7, 64])
def test_pattern_counts(room):
    rng = np.random.default_rng(room)
    for top in (1, 5, 4000):
        demand = rng.integers(0, top + 1, room)
        demand[0] = 0
        found = packing.patterns(demand, room)
        used = sum((items * use for items, use in found), np.zeros(room, int))
        assert (used <= demand).all()
        assert all(items @ np.arange(room) <= room for items, _ in found)
        if top == 4000 and room == 64:
            assert (used @ np.arange(room)) > 0.98 * (demand @ np.arange(room))


def test_patterns_match_the_bound():
    """Thirds and halves: the linear program finds that everything fits without loss."""
    demand = np.zeros(12, int)
    demand[[4, 6, 2]] = 300, 200, 600
    found = packing.patterns(demand, 12)
    assert sum(use for _, use in found) >= 298


@settings(max_examples=400, deadline=None)
@given(st.text() | st.text(alphabet=st.sampled_from("aZéßΣσİıǅ'sdlt.,!|<>endoftext́   \x85\x1c\n19ªº中ſK")))
def test_ids(text):
    ids = ids_by(PATH)
    assert np.frombuffer(ids.of(text), np.dtype(ids.kind)).tolist() == want(text)[:-1]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json"])
def test_other_tokenizer(name):
    ids = ids_by(public_tokenizers.path(name))
    text = "A word  and\nanother <|endoftext|>"
    assert np.frombuffer(ids.of(text), np.dtype(ids.kind)).tolist() == Tokenizer.from_file(public_tokenizers.path(name)).encode(text, add_special_tokens=False).ids


WORDS = st.lists(st.sampled_from(["😀", "👍", "•", "—", "“", "…", "é", "a", "the", "中", "!", ",", "🏽", "´", "ﬁ", "²"]), min_size=1, max_size=3).map("".join)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(WORDS, max_size=6).map(" ".join), min_size=1, max_size=8))
def test_ids_do_not_depend_on_earlier_texts(texts):
    """A worker that has seen any other texts, marks and symbols alone and before punctuation, gives the library's ids."""
    from fieldweave.llm.tokens import Ids

    own = ids_by(PATH)
    fresh = Ids.__new__(Ids)
    fresh.__dict__ = {**own.__dict__, "known": {}, "starts": {}}
    for text in texts:
        assert np.frombuffer(fresh.of(text), np.dtype(own.kind)).tolist() == want(text)[:-1]


@pytest.mark.parametrize("text", ["😀 😀,", "hi 👍 there 👍!", "… a …,", "x — —, y", "“ “,", "• •."])
def test_marks_alone_and_before_punctuation(text):
    ids = ids_by(PATH)
    assert np.frombuffer(ids.of(text), np.dtype(ids.kind)).tolist() == want(text)[:-1]


def test_words_met_before_are_not_tokenized_again(monkeypatch):
    import public_tokenizers

    from fieldweave.llm import tokens

    monkeypatch.setattr(tokens, "KEPT_WORDS", 7)
    ids, made = tokens.Ids(public_tokenizers.path("word_bpe_49k.json")), []
    letters = ids._letters
    monkeypatch.setattr(ids, "_letters", lambda word: made.append(word) or letters(word))
    text = "oak elm ash fir oak, elm! oak pine elm oak."
    assert ids.of(text) == ids._whole(text)
    assert max(made.count(word) for word in (b"oak", b"elm", b"ash", b"fir", b"pine")) == 1
