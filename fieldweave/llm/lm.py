"""A log-bilinear language model trained by noise-contrastive estimation, and its scores of texts."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldweave.llm.common import stored

#: Words whose counts every task holds, of at most so many bytes each; all other words are joined with their counts.
FREQUENT, FREQUENT_BYTES = 200_000, 64
#: Outcomes of the first level: all rare words as one, the end, the most frequent words, and groups of the next ones.
SINGLES, GROUPS, MEMBERS = 254, 256, 256
OTHER, STOP, FIRST_GROUP = 0, 1, 2 + SINGLES
CLASSES, SIZE = FIRST_GROUP + GROUPS, 16
#: The squares that steps of the words in groups start from.
WORD_SQUARE = 1.0
ROUNDS, NOISE, WORD_NOISE, BATCH, STEP = 1, 32, 4, 2048, 0.15
#: Bytes of text whose words are counted at a time, and that are trained on or scored at a time.
COUNTED, LEARNED = 1 << 24, 1 << 23
#: Tokens that are scored at a time, and those of a group whose normalisers are.
SCORED, SUMMED = 1 << 21, 4096


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def by_size(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The rows in batches of at most ``size`` bytes of their last column, and a few for each row, or of one row."""
    held: list[pa.RecordBatch] = []
    waiting = 0
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0).to_numpy().astype(np.int64) + 16)
        start, before = 0, 0
        while start < len(ends):
            stop = int(np.searchsorted(ends, before + size - waiting, "right"))
            if stop == start and not held:
                stop += 1
            if stop > start:
                held.append(batch.slice(start, stop - start))
                waiting += int(ends[stop - 1]) - before
                start, before = stop, int(ends[stop - 1])
            if start < len(ends):
                yield pa.concat_batches(held)
                held, waiting = [], 0
    if held:
        yield pa.concat_batches(held)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of texts as ``tokens`` has them, and how many of them each text has."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, sizes = split.flatten().cast(pa.binary()), pc.list_value_length(split).to_numpy()
    # What stands before the first blank and behind the last one may be empty.
    full = pc.binary_length(words).to_numpy() > 0
    if not full.all():
        sizes = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[full], minlength=len(sizes))
        words = words.filter(pa.array(full))
    return words, sizes


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in by_size(batches, COUNTED):
        counts = pc.value_counts(split_words(batch.column(0))[0])
        yield pa.RecordBatch.from_arrays([counts.field("values"), counts.field("counts")], names=["word", "n"])


class Model:
    """Word features, one matrix for each of the two context places, output features and biases."""

    SHAPES = {"words": (CLASSES + 1, SIZE), "first": (SIZE, SIZE), "second": (SIZE, SIZE), "out": (CLASSES, SIZE), "bias": (CLASSES,)}

    def __init__(self, unigram: np.ndarray) -> None:
        """``unigram``: counts of the classes in the training tokens; classes without any are never an outcome."""
        rng = np.random.default_rng(11)
        unigram = unigram + np.eye(CLASSES)[OTHER]  # the unseen word
        share = (unigram + 0.1 * (unigram > 0)) / max(1.0, (unigram + 0.1 * (unigram > 0)).sum())
        self.share = share.astype(np.float64)
        self.values = {k: rng.normal(0, 0.1, s).astype(np.float32) for k, s in self.SHAPES.items()}
        self.values["first"] = np.eye(SIZE, dtype=np.float32)
        self.values["second"] = np.eye(SIZE, dtype=np.float32) * np.float32(0.5)
        self.values["bias"] = np.log(np.maximum(share, 1e-30)).astype(np.float32)

    def flat(self) -> np.ndarray:
        return np.concatenate([self.values[k].ravel() for k in self.SHAPES])

    def set(self, flat: np.ndarray) -> Model:
        at = 0
        for k, shape in self.SHAPES.items():
            size = math.prod(shape)
            self.values[k] = flat[at:at + size].reshape(shape).astype(np.float32)
            at += size
        return self

    def log_probabilities(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What the two context words add to the predicted features, and the log10 normaliser of each context."""
        v = self.values
        one, two = v["words"] @ v["first"], v["words"] @ v["second"]
        bias = np.where(self.share > 0, v["bias"], np.float32(-1e30))
        total = np.empty((CLASSES + 1, CLASSES + 1), np.float32)
        for before in range(CLASSES + 1):
            logits = (one[before] + two) @ v["out"].T + bias
            top = logits.max(axis=1, keepdims=True)
            total[:, before] = top[:, 0] + np.log(np.exp(logits - top).sum(axis=1))
        return one, two, total

    def train(self, one: np.ndarray, two: np.ndarray, ids: np.ndarray, squares: dict[str, np.ndarray], rng: np.random.Generator,
              words: Words | None = None) -> None:
        """One step for a batch: the class ``one`` stands before ``ids``, the class ``two`` before that.

        Classes are told from noise of all classes; with ``words``, a word of a group from noise of its group as well.
        """
        v, word = self.values, class_of(ids)
        noise = rng.choice(CLASSES, NOISE, p=self.share)
        offset = np.log(NOISE * np.maximum(self.share, 1e-30)).astype(np.float32)
        pair, both = np.column_stack([one, two]), np.concatenate([v["first"], v["second"]])
        context = v["words"].take(pair, axis=0).reshape(len(pair), 2 * SIZE)
        q = context @ both
        out = v["out"].take(word, axis=0)
        hit = -_less_chance(np.einsum("ij,ij->i", -q, out) - v["bias"][word] + offset[word])
        drawn = v["out"][noise]
        miss = q @ drawn.T
        miss += v["bias"][noise] - offset[noise]
        miss = _less_chance(miss)
        dq = hit[:, None] * out + miss @ drawn
        size = np.float32(1 / len(word))
        if words:
            inside = np.flatnonzero(ids > CLASSES)
        if words and len(inside):
            dq[inside] += words.train(ids[inside] - CLASSES - 1, q[inside], rng)
        mixed = context.T @ dq
        steps = {
            "words": _spread(pair.ravel(), (dq @ both.T).reshape(-1, SIZE), CLASSES + 1),
            "first": mixed[:SIZE], "second": mixed[SIZE:], "out": _spread(word, hit[:, None] * q, CLASSES),
            "bias": np.bincount(word, hit, CLASSES).astype(np.float32)}
        np.add.at(steps["out"], noise, miss.T @ q)
        np.add.at(steps["bias"], noise, miss.sum(axis=0))
        for k, step in steps.items():
            step *= size
            squares[k] += step * step
            v[k] += np.float32(STEP) * step / np.sqrt(squares[k] + np.float32(1e-8))


def class_of(ids: np.ndarray) -> np.ndarray:
    """Classes of tokens; above ``CLASSES`` a token is a word of a group, numbered group by group."""
    return np.where(ids > CLASSES, FIRST_GROUP + (ids - CLASSES - 1) // MEMBERS, ids)


def _spread(places: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """Sums of the rows that go to each place."""
    width = rows.shape[1]
    cells = places[:, None] * width + np.arange(width)
    return np.bincount(cells.ravel(), rows.ravel(), size * width).reshape(size, width).astype(np.float32)


def _less_chance(x: np.ndarray) -> np.ndarray:
    """The logistic function of ``x``, negative; ``x`` is overwritten."""
    x *= np.float32(0.5)
    np.tanh(x, out=x)
    x += 1
    x *= np.float32(-0.5)
    return x


class Words:
    """The second level: for each word of a group a vector and a bias, by which a softmax over its group predicts it."""

    def __init__(self, counts: np.ndarray) -> None:
        """``counts`` of the words, group by group; those of a group come first, and 0 is no word."""
        counts = counts.reshape(GROUPS, MEMBERS)
        self.sizes = (counts > 0).sum(axis=1)
        share = (counts + 1.0) / np.maximum(1, (counts + 1.0).sum(axis=1, where=counts > 0, keepdims=True))
        self.bias = np.where(counts > 0, np.log(share), -1e30).astype(np.float32).ravel()
        self.vectors = np.zeros((GROUPS * MEMBERS, SIZE), np.float32)

    def values(self) -> np.ndarray:
        return np.column_stack([self.vectors, self.bias])

    def learner(self, values: np.ndarray) -> Words:
        """The same words with weights of their own, to be trained."""
        own = object.__new__(Words)
        own.sizes, own.weights = self.sizes, values.astype(np.float32)
        own.vectors, own.bias = own.weights[:, :SIZE], own.weights[:, SIZE]
        own.squares = np.full(len(values), WORD_SQUARE, np.float32)
        own.seen = np.zeros(len(values), np.int64)
        return own

    def train(self, place: np.ndarray, q: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        """One step that tells words from noise, any words of their groups alike; what the features ``q`` gain by."""
        group = place // MEMBERS
        size = self.sizes[group]
        rows = np.empty((len(place), 1 + WORD_NOISE), np.int64)
        rows[:, 0] = place
        rows[:, 1:] = group[:, None] * MEMBERS + (rng.random((len(place), WORD_NOISE), np.float32) * size[:, None]).astype(np.int64)
        rows = rows.ravel()
        weights = self.weights.take(rows, axis=0).reshape(len(place), -1, SIZE + 1)
        features = np.column_stack([q, np.ones(len(q), np.float32)])  # the last one is that of the bias
        x = np.einsum("ij,ikj->ik", features, weights)
        x -= np.log(WORD_NOISE / size).astype(np.float32)[:, None]
        miss = _less_chance(x)
        miss[:, 0] += 1
        dq = np.einsum("ik,ikj->ij", miss, weights)[:, :SIZE]
        # Few words stand twice in a batch: the step of a word is that of its first place, to which those of others are added.
        order = np.argsort(rows.astype(np.min_scalar_type(GROUPS * MEMBERS - 1)), kind="stable")
        rows = rows[order]
        new = np.concatenate([[True], rows[1:] != rows[:-1]])
        row, first, later = rows[new], order[new], order[~new]
        miss = miss.ravel()
        step = features.take(first // (1 + WORD_NOISE), axis=0)
        step *= miss[first, None]
        if len(later):
            np.add.at(step, (np.cumsum(new) - 1)[~new], features.take(later // (1 + WORD_NOISE), axis=0) * miss[later, None])
        squares = self.squares[row] + np.einsum("ij,ij->i", step, step) / np.float32(SIZE)
        self.squares[row] = squares
        step *= (np.float32(STEP) / np.sqrt(squares))[:, None]
        self.weights[row] += step
        self.seen[row] += np.diff(np.flatnonzero(new), append=len(rows))
        return dq

    @staticmethod
    def _norm(rows: np.ndarray) -> float:
        return math.sqrt(float(np.einsum("ij,ij->i", rows, rows).max()))

    def logs(self, place: np.ndarray, one: np.ndarray, two: np.ndarray, features: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Natural logarithms of the probabilities of words within their groups after the classes ``two`` and ``one``.

        ``features`` are what each class adds as ``one`` and as ``two``. An exponential of a sum is the product of two, so
        a group needs exponentials for each class before its words, not for each token.
        """
        found = np.empty(len(place))
        order = np.argsort(place // MEMBERS, kind="stable")
        group = (place // MEMBERS)[order]
        starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else []
        for begin, end in zip(starts, [*starts[1:], len(group)]):
            own, at = order[begin:end], group[begin] * MEMBERS
            members = slice(at, at + self.sizes[group[begin]])
            vectors, bias = self.vectors[members], self.bias[members]
            (first, x), (second, y) = _distinct(one[own]), _distinct(two[own])
            before, earlier = features[0][first], features[1][second]
            # No product is larger than that of the norms; only beyond what an exponential can hold sums come before it.
            small = (self._norm(before) + self._norm(earlier)) * self._norm(vectors) + abs(bias).max() <= 60
            before, earlier = before @ vectors.T, earlier @ vectors.T + bias
            word = place[own] - at
            logs = (before[x, word] + earlier[y, word]).astype(np.float64)
            if small:
                np.exp(before, out=before)
                np.exp(earlier, out=earlier)
            for cut in range(0, len(own), SUMMED):
                a, b = before.take(x[cut:cut + SUMMED], axis=0), earlier.take(y[cut:cut + SUMMED], axis=0)
                if small:
                    logs[cut:cut + SUMMED] -= np.log(np.einsum("ij,ij->i", a, b))
                else:
                    a += b
                    top = a.max(axis=1, keepdims=True)
                    logs[cut:cut + SUMMED] -= top[:, 0] + np.log(np.exp(a - top).sum(axis=1))
            found[own] = logs
        return found


def _distinct(classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The classes that there are, and the number of each one among them."""
    there = np.zeros(CLASSES + 1, bool)
    there[classes] = True
    return np.flatnonzero(there), (np.cumsum(there) - 1)[classes]


def _trained(shared, start: np.ndarray, values, turn: int):
    """A task's weights after one pass over its texts: a row for the first level, and one for each group of words.

    The first level is weighed by the tokens that the task saw, a word by how often it was trained.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        facts = shared.value
        model, rng, seen = Model(facts.unigram).set(start), np.random.default_rng(turn), 0
        words = facts.words.learner(values.value)
        squares = {k: np.full(s, 1e-4, np.float32) for k, s in Model.SHAPES.items()}
        held: list[np.ndarray] = []

        def learn() -> None:
            one, two, ids = (np.concatenate([x[cut] for x in held]) for cut in (slice(1, -1), slice(0, -2), slice(2, None)))
            one, two = class_of(one), class_of(two)
            order = rng.permutation(len(ids))
            for at in range(0, len(ids), BATCH):
                part = order[at:at + BATCH]
                model.train(one[part], two[part], ids[part], squares, rng, words)
            held.clear()

        waiting = 0
        for batch in by_size(batches, LEARNED):
            # Words behind these are no outcome of their own.
            _, ranks, ends = facts.ranked(batch.column(0), SINGLES + GROUPS * MEMBERS)
            for own in np.split(facts.ids(ranks, ends), ends[:-1] + 3 * np.arange(1, len(ends))):
                held.append(own)
                waiting += len(own) - 2
                if waiting >= 32 * BATCH:
                    seen += waiting
                    waiting = 0
                    learn()
        if held:
            seen += waiting
            learn()
        if seen:
            flat = model.flat()
            yield _weights(-1, np.full(len(flat), seen), flat)
            moved, times = words.vectors, words.seen.reshape(GROUPS, MEMBERS)
            for group in np.flatnonzero(times.any(axis=1)):
                rows = slice(group * MEMBERS, (group + 1) * MEMBERS)
                yield _weights(group, times[group], np.column_stack([moved[rows], words.bias[rows]]))

    return run


WEIGHTS = "place int, seen binary, weights binary"


def _weights(place: int, seen: np.ndarray, weights: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([place], pa.int32()), pa.array([seen.astype(np.float64).tobytes()], pa.binary()), pa.array([weights.astype(np.float32).tobytes()], pa.binary())],
        names=["place", "seen", "weights"])


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Averages of the weights of each place, weighed by how often each was trained."""
    sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for place, seen, weights in zip(*(batch.column(n) for n in range(3))):
            times = np.frombuffer(seen.as_py())
            own = np.frombuffer(weights.as_py(), np.float32).astype(np.float64).reshape(len(times), -1) * times[:, None]
            before = sums.get(place.as_py(), (0.0, 0.0))
            sums[place.as_py()] = before[0] + times, before[1] + own
    for place, (times, total) in sums.items():
        yield _weights(place, times, total / np.maximum(times, 1)[:, None])


class Statistics:
    """What is known of the training tokens: ``total`` of them, ``distinct`` ones, counts of the frequent words."""

    def __init__(self, frequent: list[tuple[bytes, int]], total: int, distinct: int, ends: int) -> None:
        self.total, self.distinct, self.ends = total, distinct, ends
        self.frequent = pa.array([word for word, _ in frequent], pa.binary())
        self.counts = np.array([n for _, n in frequent], np.int64)
        single, grouped = frequent[:SINGLES], frequent[SINGLES:SINGLES + GROUPS * MEMBERS]
        # Words with like endings share a group.
        order = sorted(range(len(grouped)), key=lambda n: grouped[n][0][::-1])
        per_group = -(-len(grouped) // GROUPS)
        own = np.array([n // per_group * MEMBERS + n % per_group for n in range(len(order))], np.int64)
        counts = np.zeros(GROUPS * MEMBERS, np.int64)
        counts[own] = self.counts[SINGLES:SINGLES + len(grouped)][order]
        self.words = Words(counts)
        self.unigram = np.zeros(CLASSES)
        self.unigram[2:2 + len(single)] = self.counts[:len(single)]
        self.unigram[STOP] = ends
        self.unigram[FIRST_GROUP:] = counts.reshape(GROUPS, MEMBERS).sum(axis=1)
        self.unigram[OTHER] = total - self.unigram.sum()
        #: What all words that are neither outcomes of their own nor in a group count, each once more, and one unseen word.
        self.rare_total = self.unigram[OTHER] + distinct - len(single) - len(grouped) - (ends > 0) + 1
        #: By rank, the token's number; at the end that of words without a rank.
        self.places = np.full(len(frequent) + 1, OTHER, np.int32)
        self.places[:len(single)] = np.arange(len(single)) + 2
        self.places[np.array(order, np.int64) + SINGLES] = own + CLASSES + 1

    def ranked(self, texts: pa.Array, most: int = FREQUENT) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The words of texts as ``tokens`` has them, their ranks, -1 beyond the ``most`` first ones, and the ends of the texts."""
        words, sizes = split_words(texts)
        ranks = pc.fill_null(pc.index_in(words, value_set=self.frequent.slice(0, most)), -1).to_numpy()
        return words, ranks, np.cumsum(sizes)

    def ids(self, ranks: np.ndarray, ends: np.ndarray | None = None) -> np.ndarray:
        """Classes and leaves of the words and the end, after two starts; one text after another, if there are several."""
        ends = np.array([len(ranks)]) if ends is None else ends
        texts = 3 * np.arange(len(ends))
        found = np.full(len(ranks) + 3 * len(ends), CLASSES, np.int32)
        found[np.arange(len(ranks)) + np.repeat(texts, np.diff(ends, prepend=0)) + 2] = self.places[ranks]
        found[ends + texts + 2] = STOP
        return found


def gather(texts: DataFrame) -> tuple[Statistics, DataFrame]:
    """Counts of all words of the training ``texts (text)``, and what the driver and the tasks keep of them."""
    counts = stored(texts.mapInArrow(_counted, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")))
    total, distinct = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    ends = texts.count()
    short = counts.filter(F.octet_length("word") <= FREQUENT_BYTES)
    held = short.orderBy(F.desc("n"), "word").limit(FREQUENT).toArrow()
    frequent = sorted(zip(held["word"].to_pylist(), held["n"].to_pylist()), key=lambda x: (-x[1], x[0]))
    return Statistics(frequent, (total or 0) + ends, distinct + (ends > 0), ends), counts


def fit(texts: DataFrame, facts: Statistics, shared) -> tuple[Model, np.ndarray]:
    """Each round, every task trains on all its texts from the same weights; the weights are averaged.

    The driver gets the averages of the model, whose size is fixed, whatever the corpus.
    """
    model, values = Model(facts.unigram), facts.words.values()
    context = texts.sparkSession.sparkContext
    for turn in range(ROUNDS):
        rows = texts.mapInArrow(_trained(shared, model.flat(), context.broadcast(values), turn), WEIGHTS)
        for r in rows.repartition("place").mapInArrow(_averaged, WEIGHTS).collect():
            seen, weights = np.frombuffer(r["seen"]), np.frombuffer(r["weights"], np.float32)
            if r["place"] < 0:
                model.set(weights)
            else:
                own = r["place"] * MEMBERS + np.flatnonzero(seen)
                values[own] = weights.reshape(MEMBERS, -1)[seen > 0]
    return model, values


class Scorer:
    """A model of both levels, ready to score. ``contexts`` is what its ``log_probabilities`` gave, if they are known."""

    def __init__(self, facts: Statistics, flat: np.ndarray, values: np.ndarray, contexts: tuple | None = None) -> None:
        model = Model(facts.unigram).set(flat)
        self.one, self.two, self.total = contexts or model.log_probabilities()
        self.words = facts.words.learner(values)
        self.out = model.values["out"]
        self.bias = np.where(model.share > 0, model.values["bias"], np.float32(-1e30))
        self.after_one, self.after_two = self.one @ self.out.T, self.two @ self.out.T + self.bias

    def logs(self, two: np.ndarray, one: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Natural logarithms of the probabilities of ``ids``, all rare words as one, after two tokens."""
        two, one, word = class_of(two), class_of(one), class_of(ids)
        found = (self.after_one[one, word] + self.after_two[two, word] - self.total[two, one]).astype(np.float64)
        inside = np.flatnonzero(ids > CLASSES)
        found[inside] += self.words.logs(ids[inside] - CLASSES - 1, one[inside], two[inside], (self.one, self.two))
        return found


def _scored(shared, flat: np.ndarray, values, contexts=None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        scorer = Scorer(own, flat, values.value, contexts and contexts.value)
        logs = np.append(np.log10(own.counts + 1.0), 0.0)  # the last one is that of words without a rank
        for batch in by_size(batches, LEARNED):
            words, ranks, ends = own.ranked(batch.column(1))
            rows = len(ends)
            row = np.repeat(np.arange(rows), np.diff(ends, prepend=0))
            ids = own.ids(ranks, ends)
            at = np.flatnonzero(ids != CLASSES)
            parts = [at[cut:cut + SCORED] for cut in range(0, len(at), SCORED)]
            token = np.concatenate([scorer.logs(ids[part - 2], ids[part - 1], ids[part]) for part in parts])
            model = np.add.reduceat(token, np.concatenate([[0], ends[:-1]]) + np.arange(rows)) / math.log(10)
            shared_ = own.places[ranks] == OTHER
            columns = [
                batch.column(0), np.bincount(row, minlength=rows) + 1, np.bincount(row[ranks >= 0], minlength=rows) + (own.ends > 0),
                np.bincount(row, logs[ranks], rows) + math.log10(own.ends + 1), model + np.bincount(row[shared_], logs[ranks[shared_]], rows),
                np.bincount(row[shared_], minlength=rows), _occurring(words.filter(pa.array(ranks < 0)), row[ranks < 0], rows)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["doc_id", "n_tokens", "n_known", "base", "model", "others", "rare"])

    return run


def _occurring(words: pa.Array, row: np.ndarray, rows: int) -> pa.Array:
    """For each row a list of its distinct words, with how often it has them; ``row`` says whose each word is."""
    coded = words.dictionary_encode()
    distinct = max(1, len(coded.dictionary))
    found, n = np.unique(row * distinct + coded.indices.to_numpy(), return_counts=True)
    starts = np.searchsorted(found, np.arange(rows + 1) * distinct)
    pairs = pa.StructArray.from_arrays([coded.dictionary.take(pa.array(found % distinct)), pa.array(n)], names=["word", "n"])
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pairs)


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Counts cover all training tokens. The model predicts a token from the two before it in two levels, both trained by
    noise-contrastive estimation on all training texts and normalised by products of matrices: its class, which is the end,
    one of the ``SINGLES`` most frequent words or one of ``GROUPS`` groups of words with like endings, and in a group one of
    its ``MEMBERS`` words. These 65,790 words are the model's fixed vocabulary. All other words, and words of more than
    ``FREQUENT_BYTES`` bytes, are one class more, in which each has the share of its count plus one. So the probabilities of
    all words and of one unseen word add up to one. Contexts are classes.
    Both scores need the counts of rare words: these, once per text and word, are joined with the table of counts.

    NULL and empty texts are the end alone. Rows with a NULL id are trained on. Rows that repeat an id are scored each for
    itself. Without training tokens only the unseen word is left and every score is 0. No rows give no rows; other
    columns are not read. Averages of weights may differ in their last digits from run to run, and so the score.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    training = texts.filter(~held_out(F.col("doc_id"))).select("text")
    facts, counts = gather(training)
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(facts)
    model, values = fit(training, facts, shared)
    # The normalisers of all pairs of classes, about 1 MB, are worked out once and not in every task.
    contexts = context.broadcast(model.log_probabilities())
    found = stored(
        texts.mapInArrow(_scored(shared, model.flat(), context.broadcast(values), contexts), "doc_id long, n_tokens long, n_known long, base double, model double, "
                         "others long, rare array<struct<word:binary,n:long>>").withColumn("row", F.monotonically_increasing_id()))
    rare = found.select("row", F.explode("rare").alias("r")).select("row", "r.word", F.col("r.n").alias("times"))
    joined = rare.join(counts.withColumnRenamed("n", "c"), "word").groupBy("row").agg(
        F.sum("times").alias("known"), F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("logs"))
    base_total, rare_total = math.log10(facts.total + facts.distinct + 1), math.log10(facts.rare_total)
    logs = F.coalesce("logs", F.lit(0.0))
    empty = F.lit(facts.total == 0)
    return found.drop("rare").join(joined, "row", "left").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"), F.lit(facts.total).cast("long").alias("train_tokens"),
        F.when(empty, 0.0).otherwise(F.col("base") + logs - F.col("n_tokens") * base_total).alias("base_score"),
        F.when(empty, 0.0).otherwise(F.col("model") + logs - F.col("others") * rare_total).alias("score"))
