import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldweave.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
ALPHABET = "abcdefg   ▁▁\n\t\x00éßΣ中文😀👍🏽<s>0x0A</s>123.,!'Ａ①㌔ｶﾞﬁ́​　²½\xa0"


def library(processor, text):
    return [(p.id, p.begin, p.end) for p in processor.encode(text, return_type="proto").pieces]


def ours(model, text):
    ids, begins, ends = model.encode(text)
    return list(zip(ids.tolist(), begins.tolist(), ends.tolist()))


@settings(max_examples=400, deadline=None)
@given(st.text() | st.text(alphabet=st.sampled_from(ALPHABET)))
def test_ids_and_places(text):
    model = pieces.pieces_by(PATH)
    got = ours(model, text)
    assert got == library(LIBRARY, text)
    assert model.decode([i for i, _, _ in got]) == LIBRARY.decode([i for i, _, _ in got]) == text.replace("▁", " ")


@pytest.mark.parametrize("text", ["x" * 5000, "日本語" * 2000, "-" * 3000 + "=" * 999, " " * 700, "ab " * 9000])
def test_long_words(text):
    assert ours(pieces.pieces_by(PATH), text) == library(LIBRARY, text)


def test_pairs_are_scored_once():
    """A merge scores the two pairs beside it anew, not all pairs of the word."""
    class Counted(dict):
        asked = 0

        def get(self, *args):
            self.asked += 1
            return super().get(*args)

    model = pieces.Pieces(PATH)
    model.scores = Counted(model.scores)
    for word in ["representation", "undocumented", "straightforwardly", "x", "zzqxj"]:
        assert [i for i, _, _ in ours(model, word)] == LIBRARY.encode(word)
        assert model.scores.asked <= 3 * (len(word) + 1)
        model.scores.asked = 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([0, 1, 2, 259, 260, 28705]) | st.integers(3, 258) | st.integers(0, 31999), max_size=9))
def test_decoding_of_any_ids(ids):
    assert pieces.pieces_by(PATH).decode(ids) == LIBRARY.decode(ids)


def number(n):
    return bytes([n & 127 | (128 if n > 127 else 0)]) + (number(n >> 7) if n > 127 else b"")


def field(n, body):
    return number(n << 3 | 2) + number(len(body)) + body


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
@pytest.mark.parametrize("trims", [True, False])
@pytest.mark.parametrize("prefix", [True, False])
@pytest.mark.parametrize("by_byte", [True, False])
def test_compiled_character_maps(tmp_path, rule, trims, prefix, by_byte):
    """The same pieces behind another normaliser; without byte pieces unknown characters are one unknown piece."""
    with open(PATH, "rb") as file:
        raw = file.read()
    if not by_byte:
        is_byte = lambda n, v: n == pieces.PIECES and dict(pieces._fields(v)).get(3) == pieces.BYTE
        raw = b"".join(field(n, v + (number(3 << 3) + number(pieces.NORMAL) if is_byte(n, v) else b"")) for n, v in pieces._fields(raw))
    spec = sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_normalizer_spec()
    switches = b"".join(number(n << 3) + number(int(v)) for n, v in ((3, prefix), (4, trims), (5, True)))
    path = tmp_path / "own.model"
    path.write_bytes(raw + field(pieces.NORMALIZER, spec + switches) + field(pieces.TRAINER, number(35 << 3) + number(int(by_byte))))
    theirs, model = sentencepiece.SentencePieceProcessor(model_file=str(path)), pieces.Pieces(str(path))
    rng = random.Random(4)
    for _ in range(400):
        text = "".join(rng.choice(ALPHABET) for _ in range(rng.randrange(30)))
        got = ours(model, text)
        assert got == library(theirs, text)
        assert model.decode([i for i, _, _ in got]) == theirs.decode([i for i, _, _ in got])


def test_other_models_are_refused(tmp_path):
    with open(PATH, "rb") as file:
        raw = file.read()
    path = tmp_path / "unigram.model"
    path.write_bytes(raw + field(pieces.TRAINER, number(3 << 3) + number(1)))
    with pytest.raises(ValueError, match="byte-pair"):
        pieces.Pieces(str(path))


def test_edges(spark):
    texts = [(1, None), (2, ""), (3, " "), (4, "a " * 40000), (4, "a " * 40000), (None, "héllo"), (5, "😀" * 3)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in texts], "doc_id long, text string, ids string, begins int")
    rows = pieces.encode_texts(docs, PATH).collect()
    key = lambda row: (row[0] or 0, str(row[1:]))
    want = [(i, [p for p, _, _ in library(LIBRARY, t or "")], [b for _, b, _ in library(LIBRARY, t or "")],
             [e for _, _, e in library(LIBRARY, t or "")], t or "") for i, t in texts]
    assert sorted(map(tuple, rows), key=key) == sorted(want, key=key)


def test_empty(spark):
    assert pieces.encode_texts(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_digests(spark, folder):
    import __spark_entry__ as entry

    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = entry.queries()["op11_pieces"](spark, folder).collect()
    assert len(rows) == len(docs)
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    for r in rows:
        ids = LIBRARY.encode(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(LIBRARY.decode(ids)))
        assert r.last_byte == len(docs[r.doc_id].encode())
