import math
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldweave.llm import lm


def trains(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 7 != 2


def brute(docs):
    words = [lm.tokens(t) + [None] for _, t in docs]
    counts = Counter(w for (i, _), own in zip(docs, words) if trains(i) for w in own)
    total, distinct = sum(counts.values()), len(counts)
    return [(i, not trains(i), len(own), sum(counts[w] > 0 for w in own), total,
             sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in own)) for (i, _), own in zip(docs, words)]


def test_documents(spark, folder, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 900)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = {r.doc_id: r for r in lm.score_texts(docs.repartition(3)).collect()}
    gain = {True: 0.0, False: 0.0}
    for want in brute([(r.doc_id, r.text) for r in docs.collect()]):
        got = rows[want[0]]
        assert tuple(got)[:5] == want[:5] and got.base_score == pytest.approx(want[5])
        gain[got.held_out] += got.score - got.base_score
    assert len(rows) == docs.count() and gain[True] > 0 and gain[False] > 0


def facts_of(n, rare=5000, ends=40):
    frequent = [(f"w{k:05}".encode(), 100_000 - k) for k in range(n)]
    return lm.Statistics(frequent, rare + sum(c for _, c in frequent) + ends, n + 200 + (ends > 0), ends)


def trained(facts, draw, steps):
    model, rng = lm.Model(facts.unigram), np.random.default_rng(0)
    words = facts.words.learner(facts.words.values())
    squares = {k: np.full(s, 1e-4, np.float32) for k, s in lm.Model.SHAPES.items()}
    for _ in range(steps):
        model.train(*draw(rng), squares, rng, words)
    return lm.Scorer(facts, model.flat(), words.values())


@pytest.mark.parametrize("n", [3, 254, 255, 700, 70_000])
def test_probabilities_add_up(n):
    """Over every word that training saw, the end and one unseen word, after any context."""
    facts = facts_of(n)
    known = np.unique(facts.places[:-1])
    every = np.concatenate([[lm.OTHER, lm.STOP], known[known > 1]])
    assert len(every) == 2 + min(n, lm.SINGLES + lm.GROUPS * lm.MEMBERS)
    scorer = trained(facts, lambda rng: (rng.integers(0, lm.CLASSES + 1, 200), rng.integers(0, lm.CLASSES + 1, 200), rng.choice(every, 200)), 20)
    for two, one in ((lm.CLASSES, lm.CLASSES), (3, 7), (every[-1], lm.STOP)):
        logs = scorer.logs(np.full(len(every), two), np.full(len(every), one), every)
        assert np.exp(logs).sum() == pytest.approx(1, abs=1e-3)
    # Words of the class of all others have the share of their counts plus one, and so has an unseen one.
    others = sum(int(c) + 1 for c in facts.counts[lm.SINGLES + lm.GROUPS * lm.MEMBERS:])
    assert facts.rare_total == others + 5000 + 200 + 1


def test_scores_against_a_plain_softmax():
    """The same by loops over classes and members, without any batch."""
    facts = facts_of(900)
    rng = np.random.default_rng(1)
    ids = np.unique(facts.places[:-1])
    scorer = trained(facts, lambda r: (r.integers(0, lm.CLASSES + 1, 300), r.integers(0, lm.CLASSES + 1, 300), r.choice(ids, 300)), 15)
    two, one, word = (rng.choice(ids, 50) for _ in range(3))
    got = scorer.logs(two, one, word)
    for n in range(50):
        q = (scorer.one[lm.class_of(one[n:n + 1])] + scorer.two[lm.class_of(two[n:n + 1])])[0].astype(float)
        logits = [float(q @ scorer.out[c]) + float(scorer.bias[c]) for c in range(lm.CLASSES)]
        want = logits[int(lm.class_of(word[n:n + 1])[0])] - math.log(sum(map(math.exp, logits)))
        if word[n] > lm.CLASSES:
            at = int(word[n]) - lm.CLASSES - 1
            first = at // lm.MEMBERS * lm.MEMBERS
            members = range(first, first + int(scorer.words.sizes[at // lm.MEMBERS]))
            own = {m: float(q @ scorer.words.vectors[m]) + float(scorer.words.bias[m]) for m in members}
            want += own[at] - math.log(sum(map(math.exp, own.values())))
        assert got[n] == pytest.approx(want, rel=1e-3, abs=1e-3)


def test_context_is_learned(spark):
    docs = spark.createDataFrame([(n, "a b c d " * 60) for n in range(60)], "doc_id long, text string")
    for r in lm.score_texts(docs).collect():
        assert r.score > 0.6 * r.base_score


def test_edges(spark):
    docs = [(1, None), (2, ""), (None, "A a\x1fb   É"), (3, "x" * 100 + " y"), (3, "x" * 100), (4, "z " * 40000), (5, "unseen é"), (17, "q")]
    frame = spark.createDataFrame([(i, t, 1, "c", 0.5) for i, t in docs], "doc_id long, text string, n int, word string, score double")
    rows = lm.score_texts(frame).collect()
    key = lambda r: str((r[0], r[2], r[5]))
    for got, want in zip(sorted(map(tuple, rows), key=key), sorted(brute(docs), key=key)):
        assert got[:5] == want[:5] and got[5] == pytest.approx(want[5]) and math.isfinite(got[6]) and got[6] <= 0


def test_empty(spark):
    assert lm.score_texts(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    alone = next(n for n in range(100) if not trains(n))
    row = lm.score_texts(spark.createDataFrame([(alone, "a b")], "doc_id long, text string")).first()
    assert tuple(row) == (alone, True, 3, 0, 0, 0.0, 0.0)


def test_groups_learn_which_of_their_words_follows():
    facts = facts_of(1400)
    ids = facts.places[:-1]
    grouped = np.sort(ids[ids > lm.CLASSES])
    group = lm.class_of(grouped)
    pair = np.array([grouped[group == g][:2] for g in np.unique(group) if (group == g).sum() > 1])
    contexts = np.arange(2, 2 + len(pair))

    def draw(rng):
        n = rng.integers(0, len(pair), 512)
        return contexts[n], np.full(512, 3), pair[n, contexts[n] % 2]

    scorer = trained(facts, draw, 500)
    two = np.full(len(pair), 3)
    right = scorer.logs(two, contexts, pair[np.arange(len(pair)), contexts % 2])
    wrong = scorer.logs(two, contexts, pair[np.arange(len(pair)), 1 - contexts % 2])
    assert (right - wrong).mean() > 1


def test_score_of_a_text_by_hand(spark):
    """A text's score is the sum over its tokens of the model's logarithms, rare words by their share."""
    texts = [(n, " ".join(f"a{(n * k) % 700}" for k in range(1, 120))) for n in range(40)] + [(777, "a1 a2 unseen a2 a699")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    facts, counts = lm.gather(docs.filter(~lm.held_out(docs.doc_id)).select("text"))
    model, values = lm.fit(docs.filter(~lm.held_out(docs.doc_id)).select("text").coalesce(1), facts, spark.sparkContext.broadcast(facts))
    scorer = lm.Scorer(facts, model.flat(), values)
    words = lm.tokens(texts[-1][1])
    ranks = facts.ranked(pa.array([texts[-1][1]]))[1]
    ids = facts.ids(ranks)
    logs = scorer.logs(ids[:-2], ids[1:-1], ids[2:]) / math.log(10)
    rare = [math.log10(1 / facts.rare_total) for rank in ranks if rank < 0]
    assert len(rare) >= 1 and len(ranks) == len(words)

    class Shared:
        def __init__(self, value):
            self.value = value

    batch = pa.RecordBatch.from_pandas(pd.DataFrame({"doc_id": [777], "text": [texts[-1][1]]}))
    row = pa.Table.from_batches(lm._scored(Shared(facts), model.flat(), Shared(values))(iter([batch]))).to_pylist()[0]
    assert row["model"] - row["others"] * math.log10(facts.rare_total) == pytest.approx(logs.sum() + sum(rare))


def test_scores_of_many_texts_are_those_of_each(monkeypatch):
    """Texts scored together, and cut anywhere, give what each gives alone."""
    texts = ["w00001 w00300 w00899 new new", None, "", "w00005 other w00300 " * 30, "w00002", "new"]
    facts = lm.Statistics([(f"w{k:05}".encode(), 1000 - k) for k in range(900)], 10 ** 6, 1000, 40)
    model, values = lm.Model(facts.unigram), facts.words.values()

    class Shared:
        def __init__(self, value):
            self.value = value

    def rows(part):
        batch = pa.RecordBatch.from_arrays([pa.array(range(len(part))), pa.array(part, pa.string())], names=["doc_id", "text"])
        return [{k: v for k, v in r.items() if k != "doc_id"} for b in lm._scored(Shared(facts), model.flat(), Shared(values))(iter([batch])) for r in b.to_pylist()]

    alone = [rows([t])[0] for t in texts]
    monkeypatch.setattr(lm, "SCORED", 13)
    for got, want, text in zip(rows(texts), alone, texts):
        others = Counter(w for w in lm.tokens(text) if not w.startswith(b"w0"))
        assert {r["word"]: r["n"] for r in got.pop("rare")} == {r["word"]: r["n"] for r in want.pop("rare")} == others
        assert got == pytest.approx(want, rel=1e-5) and got["n_tokens"] == len(lm.tokens(text)) + 1 and got["others"] == others.total()


def test_statistics_are_bounded(spark, monkeypatch):
    """However many words there are, tasks hold so many; the others are counted all the same."""
    monkeypatch.setattr(lm, "FREQUENT", 50)
    facts, counts = lm.gather(spark.createDataFrame([(" ".join(f"w{n}" for n in range(500)),)] * 12, "text string"))
    assert len(facts.frequent) == 50 and facts.total == 12 * 501 and facts.distinct == 501 and counts.count() == 500


@settings(max_examples=200, deadline=None)
@given(st.lists(st.none() | st.text() | st.text(alphabet="aAbÉé \t\n\x0b\x0c\r\x1c\x1f\x85\xa0\u2003\x00"), max_size=5))
def test_words_of_a_batch(texts):
    """Words, ranks and ends of many texts at once are those of each text."""
    facts = lm.Statistics([(b"a", 9), (b"ab", 8), (b"b", 7)], 30, 4, 3)
    words, ranks, ends = facts.ranked(pa.array(texts, pa.string()))
    own = [lm.tokens(t) for t in texts]
    assert words.to_pylist() == [w for t in own for w in t]
    assert ends.tolist() == np.cumsum([len(t) for t in own]).tolist()
    assert ranks.tolist() == [{b"a": 0, b"ab": 1, b"b": 2}.get(w, -1) for t in own for w in t]


def test_contexts_once(spark, monkeypatch):
    """Normalisers are worked out once by the driver, whatever the number of tasks."""
    made, log_probabilities = [], lm.Model.log_probabilities
    monkeypatch.setattr(lm.Model, "log_probabilities", lambda model: made.append(1) or log_probabilities(model))
    texts = [" A b\tb ", None, "", "É a\x0bé", "a\x0cB  c"] * 8
    rows = lm.score_texts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)).collect()
    assert len(made) == 1
    assert all(r.n_tokens == len(lm.tokens(texts[r.doc_id])) + 1 for r in rows)


def test_exponentials_by_classes_not_by_tokens(monkeypatch):
    """The normalisers of a group need exponentials for each class before its words, however many tokens there are."""
    facts = facts_of(1400)
    rng, ids = np.random.default_rng(2), np.unique(facts.places[:-1])
    contexts = np.arange(2, 22)
    scorer = trained(facts, lambda r: (r.choice(contexts, 300), r.choice(contexts, 300), r.choice(ids, 300)), 15)
    two, one, word = rng.choice(contexts, 20_000), rng.choice(contexts, 20_000), rng.choice(ids[ids > lm.CLASSES], 20_000)
    made, exp = [], np.exp
    monkeypatch.setattr(lm.np, "exp", lambda x, *rest, **named: made.append(np.size(x)) or exp(x, *rest, **named))
    got = scorer.logs(two, one, word)
    monkeypatch.undo()
    assert np.isfinite(got).all() and sum(made) <= 2 * len(contexts) * facts.words.sizes.sum()


@pytest.mark.parametrize("scale", [0.1, 3, 30])
def test_logs_within_groups_of_any_size_of_weights(monkeypatch, scale):
    """Beyond what an exponential holds as well, and cut at any number of tokens."""
    monkeypatch.setattr(lm, "SUMMED", 7)
    facts, rng = facts_of(5000), np.random.default_rng(3)
    values = np.column_stack([rng.normal(0, scale, (lm.GROUPS * lm.MEMBERS, lm.SIZE)), facts.words.bias]).astype(np.float32)
    words = facts.words.learner(values)
    features = [rng.normal(0, 1, (lm.CLASSES + 1, lm.SIZE)).astype(np.float32) for _ in range(2)]
    ids = facts.places[:-1]
    place = rng.choice(ids[ids > lm.CLASSES] - lm.CLASSES - 1, 600)
    one, two = (rng.integers(0, lm.CLASSES + 1, 600) for _ in range(2))
    for at, got in enumerate(words.logs(place, one, two, features)):
        first = place[at] // lm.MEMBERS * lm.MEMBERS
        own = values[first:first + facts.words.sizes[place[at] // lm.MEMBERS]].astype(float)
        logits = own[:, :-1] @ (features[0][one[at]].astype(float) + features[1][two[at]]) + own[:, -1]
        top = logits.max()
        assert got == pytest.approx(logits[place[at] - first] - top - math.log(np.exp(logits - top).sum()), rel=1e-3, abs=2e-3)


@pytest.mark.parametrize("different", [1, 40, 5000])
def test_steps_of_words(different):
    """A step of many tokens, whose words and noise repeat, against a plain sum."""
    facts, rng = facts_of(6000), np.random.default_rng(4)
    start = np.column_stack([rng.normal(0, 1, (lm.GROUPS * lm.MEMBERS, lm.SIZE)), facts.words.bias]).astype(np.float32)
    words = facts.words.learner(start)
    ids = facts.places[:-1]
    place = rng.choice((ids[ids > lm.CLASSES] - lm.CLASSES - 1)[:different], 400)
    q = rng.normal(0, 1, (400, lm.SIZE)).astype(np.float32)
    dq = words.train(place, q, np.random.default_rng(5))
    sizes = facts.words.sizes[place // lm.MEMBERS]
    noise = (place // lm.MEMBERS * lm.MEMBERS)[:, None] + (np.random.default_rng(5).random((400, lm.WORD_NOISE), np.float32) * sizes[:, None]).astype(int)
    step, seen, gain = np.zeros(start.shape), np.zeros(len(start)), np.zeros(q.shape)
    for n in range(400):
        for k, row in enumerate([place[n], *noise[n]]):
            x = float(start[row, :-1].astype(float) @ q[n]) + start[row, -1] - math.log(lm.WORD_NOISE / sizes[n])
            miss = (k == 0) - 1 / (1 + math.exp(-x))
            step[row] += miss * np.append(q[n], 1)
            gain[n] += miss * start[row, :-1]
            seen[row] += 1
    squares = lm.WORD_SQUARE + (step ** 2).sum(axis=1) / lm.SIZE
    assert dq == pytest.approx(gain, rel=1e-3, abs=1e-4) and words.seen.tolist() == seen.tolist()
    # The sum of squares is over the bias, too.
    want = start + lm.STEP * step / np.sqrt(squares)[:, None]
    assert np.column_stack([words.vectors, words.bias]) == pytest.approx(want, rel=1e-3, abs=1e-4)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.none() | st.text(max_size=40), max_size=6), max_size=6), st.integers(1, 200))
def test_batches_by_size(texts, size):
    """All rows in their order, in batches as large as they may be; the words are looked up once for each."""
    batches = [pa.RecordBatch.from_arrays([pa.array(own, pa.string())], names=["text"]) for own in texts]
    got = [batch.column(0).to_pylist() for batch in lm.by_size(iter(batches), size)]
    assert [t for own in got for t in own] == [t for own in texts for t in own]
    large = lambda own: sum(16 + len((t or "").encode()) for t in own)
    assert all(own and (len(own) == 1 or large(own) <= size) for own in got)
    assert all(large(own + after[:1]) > size for own, after in zip(got, got[1:]))


def test_numbers_of_many_texts():
    facts = facts_of(900)
    texts = ["w00001 x w00800", None, "", "w00002 " * 5, "w00899"]
    _, ranks, ends = facts.ranked(pa.array(texts))
    assert facts.ids(ranks, ends).tolist() == [n for t in texts for n in facts.ids(facts.ranked(pa.array([t], pa.string()))[1])]
    few = facts.ranked(pa.array(texts), 800)[1]
    assert few.tolist() == [r if r < 800 else -1 for r in ranks]
