"""Toxicity scores from a learned lexicon, with misspelled terms and the context of each mention."""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldweave.llm.common import forget, in_parts, packed_row, stored

#: About so many labelled texts of either kind are learned from.
TOXIC_TEXTS, CLEAN_TEXTS = 3000, 12000
#: A term is a word of any length, or a beginning of words of 4 to 8 letters.
STEMS = (4, 5, 6, 7, 8)
#: Terms stand behind so many different words at least, and that share of the toxic texts has them.
LEAST_CONTEXTS, LEAST_SHARE = 4, 0.01
#: Log odds from which a term counts, and at which its weight ends.
LEAST_WEIGHT, MOST_WEIGHT = 3.0, 6.0
#: Letters from which a term may be misspelled by one edit, and the share of the terms, the strongest, that may be.
FUZZY_LETTERS, FUZZY_SHARE = 5, 0.5
#: The share of clean texts with a word one edit away from a term that the sample does not show, from which on the term
#: is not taken for misspelled. As usual it is estimated by the words that a single text of the sample has.
LOOKALIKES = 0.001
#: What a mention counts if misspelled, and if quoted or talked about.
MISSPELLED, QUOTED = 0.7, 0.2
#: Words before a mention that may speak about it.
CONTEXT = 3
#: Evidence at which the score is one half.
EVEN = 4.0
PREDICTED = 0.3
KEPT_WORDS = 150_000

QUOTES = {'"': '"', "“": "”", "„": "“", "«": "»", "»": "«", "‘": "’", "‹": "›", "`": "`"}
#: Words that speak about a term rather than use it.
ABOUT = {"word", "words", "term", "terms", "quote", "quoted", "quotes", "called", "said", "says", "phrase", "meaning", "definition", "slur", "insult"}
_ABOUT = {word.encode() for word in ABOUT}
_QUOTATION_MARKS = re.compile("[" + "".join({*QUOTES, *QUOTES.values()}) + "]")
#: Punctuation beyond ASCII: inverted marks, guillemets, dashes, quotation marks, ellipses, and the wide forms of the ASCII ones.
_PUNCTUATION = re.compile("[\u00a1\u00ab\u00b7\u00bb\u00bf\u2010-\u2027\u2030-\u205e\u3001-\u3003\u3008-\u3011\uff01-\uff0f\uff1a-\uff20]")

_MARKS = bytes(c + 32 if 65 <= c <= 90 else 32 if c < 48 or 58 <= c < 97 or 123 <= c < 128 else c for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words in lower case: letters, digits and what is neither ASCII nor punctuation."""
    lower = (text or "").lower()
    if not lower.isascii():
        lower = _PUNCTUATION.sub(" ", lower)
    return lower.encode("utf-8", "replace").translate(_MARKS).split()


class Lexicon:
    """Terms in a trie, intersected with the Levenshtein automaton of each of them.

    A state is a set of (trie node, edits so far, letter owed by a swap). States and their transitions are made when a
    word first needs them, so a word costs one look-up per letter until no term can match it any more.
    """

    def __init__(self, terms: dict[str, tuple[bool, float]], excepted: frozenset[bytes] = frozenset(),
                 literal: frozenset[str] = frozenset()) -> None:
        """``terms``: whether it is a stem, and its weight. ``excepted``: words that only look misspelled; ``literal``: terms never misspelled."""
        self.terms, self.excepted, self.literal = terms, excepted, literal
        # A rank, as weights grow with the number of labelled texts.
        least = sorted((weight for _, weight in terms.values()), reverse=True)[math.ceil(len(terms) * FUZZY_SHARE) - 1] if terms else 0.0
        self.fuzzy = {t for t, (_, weight) in terms.items() if len(t) >= FUZZY_LETTERS and weight >= least and t not in literal}
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[str | None] = [None]
        for term in terms:
            node = 0
            for letter in term:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.ends.append(None)
                node = self.children[node][letter]
            self.ends[node] = term
        self.start = self._closed({(0, 0, "")})
        self.moves: dict[tuple[frozenset, str], frozenset] = {}
        self.known: dict[bytes, tuple[str, bool] | None] = {}

    def _closed(self, states: set) -> frozenset:
        """With the states that leaving out a letter of the term leads to."""
        more = set(states)
        for node, edits, owed in states:
            if not edits and not owed:
                more |= {(child, 1, "") for child in self.children[node].values()}
        return frozenset(more)

    def _moved(self, states: frozenset, letter: str) -> frozenset:
        following = set()
        for node, edits, owed in states:
            if owed:
                if owed == letter:
                    following.add((node, edits, ""))
                continue
            if letter in self.children[node]:
                following.add((self.children[node][letter], edits, ""))
            if not edits:
                following.add((node, 1, ""))
                for other, child in self.children[node].items():
                    following.add((child, 1, ""))
                    if letter in self.children[child]:
                        following.add((self.children[child][letter], 1, other))
        return self._closed(following)

    def match(self, word: bytes) -> tuple[str, bool] | None:
        """(term, misspelled) of a word; a term as it is spelled goes first.

        A stem is misspelled if one edit turns the beginning of the word into it.
        """
        if word in self.known:
            return self.known[word]
        states, stem, found = self.start, None, None
        near: set[str] = set()
        for letter in word.decode("utf-8", "replace"):
            step = (states, letter)
            if step not in self.moves:
                self.moves[step] = self._moved(states, letter)
            states = self.moves[step]
            if not states:
                break
            for n, e, o in states:
                term = self.ends[n]
                if term and not o and self.terms[term][0]:
                    if e:
                        near.add(term)
                    else:
                        stem = stem or term
        if stem:
            found = (stem, False)
        else:
            ends = [(e, self.ends[n]) for n, e, o in states if not o and self.ends[n] and not self.terms[self.ends[n]][0]]
            ends += [(1, term) for term in near]
            ends = [(e, t) for e, t in ends if not e or (t in self.fuzzy and word not in self.excepted)]
            if ends:
                edits, term = min(ends)
                found = (term, bool(edits))
        if len(self.known) >= KEPT_WORDS:
            self.known.clear()
        self.known[word] = found
        return found

    def evidence(self, text: str | None) -> float:
        """The sum over the terms in a text of the strongest mention of each."""
        words = words_of(text)
        known, match = self.known, self.match
        hits = []
        for place, word in enumerate(words):
            found = known[word] if word in known else match(word)
            if found:
                hits.append((place, word, found))
        if not hits:
            return 0.0
        quoted = _quoted(text, words, [place for place, _, _ in hits])
        best: dict[str, float] = {}
        for (_, _, (term, misspelled)), aside in zip(hits, quoted):
            strength = self.terms[term][1] * (MISSPELLED if misspelled else 1) * (QUOTED if aside else 1)
            best[term] = max(best.get(term, 0.0), strength)
        return sum(best.values())


def _beside(text: str, at: int) -> str:
    """What stands at a place of a text: a ``word`` character of ASCII, a ``blank`` or the text's end, or some ``other`` one."""
    if not 0 <= at < len(text) or text[at].isspace():
        return "blank"
    return "word" if text[at].isascii() and text[at].isalnum() else "other"


def _opens(text: str, at: int) -> bool:
    mark = text[at]
    if QUOTES.get(mark) != mark:
        return mark in QUOTES
    before, after = _beside(text, at - 1), _beside(text, at + 1)
    return before != "word" and (after != "blank" or before == "blank")


def _closes(text: str, at: int) -> bool:
    mark = text[at]
    if mark != "’" and QUOTES.get(mark) != mark:
        return True
    before, after = _beside(text, at - 1), _beside(text, at + 1)
    return after != "word" and (before != "blank" or after == "blank")


def _quotations(text: str) -> tuple[list[int], list[int]]:
    """Where the outermost quotations of a text begin and end.

    A mark that looks the same at both ends does not open behind a word nor close before one, so inches open nothing, and an
    apostrophe within a word closes nothing. One with a blank on one side goes with the other side. A mark whose partner does
    not follow opens nothing.
    """
    marks = [m.start() for m in _QUOTATION_MARKS.finditer(text)]
    last = {text[at]: at for at in marks if _closes(text, at)}
    begins: list[int] = []
    ends: list[int] = []
    for at in marks:
        if len(begins) > len(ends):
            if text[at] == QUOTES[text[begins[-1]]] and _closes(text, at):
                ends.append(at)
        elif _opens(text, at) and last.get(QUOTES[text[at]], -1) > at:
            begins.append(at)
    return begins, ends


def _quoted(text: str, words: list[bytes], places: list[int]) -> list[bool]:
    """For each place: whether the word stands in a quotation, however long, or is talked about by the words before it."""
    lower = text.lower()
    starts, at = [], 0
    for word in words:
        plain = word.decode("utf-8", "replace")
        begin = lower.find(plain, at)
        begin = at if begin < 0 else begin
        at = begin + len(plain)
        starts.append(begin)
    begins, ends = _quotations(lower)
    found = []
    for place in places:
        n = bisect_right(begins, starts[place])
        found.append(bool(n) and starts[place] < ends[n - 1] or not _ABOUT.isdisjoint(words[max(0, place - CONTEXT):place]))
    return found


def score(evidence: float) -> float:
    return 1 / (1 + math.exp(EVEN - evidence))


def _features(words: list[bytes]) -> dict[str, bytes]:
    """Each word (with a blank behind it) and stem of a text, with the word before its first mention."""
    found: dict[str, bytes] = {}
    before = b""
    for raw in words:
        word = raw.decode("utf-8", "replace")
        if word + " " not in found:
            found[word + " "] = before
            for size in STEMS:
                if len(word) >= size:
                    found.setdefault(word[:size], before)
        before = raw
    return found


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_parts(batches):
        rows = [pair for text in batch.column(0).to_pylist() for pair in _features(words_of(text)).items()]
        terms, contexts = zip(*rows) if rows else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array(contexts, pa.binary())], names=["term", "context"])


def _used(text: str | None, wanted: frozenset[str]) -> set[str]:
    """The wanted terms that a text has in a mention that is neither quoted nor talked about."""
    words = words_of(text)
    found = wanted.intersection(_features(words))
    if not found or not (any(mark in text for mark in QUOTES) or any(word in _ABOUT for word in words)):
        return found
    places = [place for place, word in enumerate(words) if not found.isdisjoint(_features([word]))]
    aside = _quoted(text, words, places)
    return found.intersection(_features([words[place] for place, quoted in zip(places, aside) if not quoted]))


def _counted(wanted: frozenset[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(_used(text, wanted))
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["term", "n"])

    return run


def _lookalikes(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(w for w in set(words_of(text)) if (hit := lexicon.match(w)) and hit[1])
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    return run


def chosen_terms(counts: dict[str, tuple[int, int]], toxic: int, clean: int) -> dict[str, tuple[bool, float]]:
    """Terms (stem or not, weight) from counts (contexts in toxic texts, clean texts); ``word `` is a whole word.

    A term's weight is its log odds with the counts moved by one standard deviation towards clean. Terms are taken by
    weight and frequency, the longest first among equals. What begins with a stem that is taken adds nothing, and of a
    stem of terms that are taken only the mentions that are none of theirs count.
    """
    least = max(LEAST_CONTEXTS, LEAST_SHARE * toxic)

    def weight(n: float, other: float) -> float:
        sure = math.log((n - math.sqrt(n) + 0.5) / (toxic + 1)) - math.log((other + math.sqrt(other) + 0.5) / (clean + 1))
        return min(sure, MOST_WEIGHT) if n >= least else 0.0

    order = sorted(((weight(*counts[t]), counts[t][0], len(t), t) for t in counts), reverse=True)
    found: dict[str, tuple[bool, float]] = {}
    explained: Counter[str] = Counter()
    for sure, n, _, term in order:
        if sure < LEAST_WEIGHT:
            break
        shorter = [term[:size] for size in range(STEMS[0], len(term))]
        if any(found.get(s, (False, 0))[0] for s in shorter):
            continue
        if explained[term]:
            sure = weight(max(0, n - explained[term]), counts[term][1])
            if sure < LEAST_WEIGHT:
                continue
        found[term.rstrip(" ")] = (not term.endswith(" "), sure)
        explained.update({s: n for s in shorter})
    return found


def held_out(doc_id) -> F.Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Lexicon:
    """The lexicon from the texts of ``docs`` that ``labels (doc_id, toxic)`` has, without those held out.

    A sample of ``TOXIC_TEXTS`` and ``CLEAN_TEXTS`` texts, drawn by a hash of the id, is stored. Terms of toxic texts are
    counted by the different words before them, so that copies of a text count once; as those that are looked at have a hundredth of
    the toxic texts, they are at most a hundred times the mean number of words and stems of a text. They are counted then by the clean texts that use
    them: mentions that are quoted or talked about are left out. Words of clean texts that one edit turns into a term are excepted, and a term is not taken for misspelled at all if
    further such words are expected in more than the share ``LOOKALIKES`` of clean texts. A document labelled twice is toxic if any label
    says so; NULL ids and labels are left out. Without toxic labels the lexicon is empty.
    """
    rows = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    rows = rows.groupBy(F.col("doc_id").alias("label_id")).agg(F.max("toxic").alias("toxic"))
    there = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.when(F.col("toxic") == 1, min(1.0, TOXIC_TEXTS / there.get(1, 1))).otherwise(min(1.0, CLEAN_TEXTS / there.get(0, 1)))
    drawn = rows.filter(F.pmod(F.xxhash64("label_id"), F.lit(1_000_000)) < share * 1_000_000)
    # The sample is bounded by the two numbers above.
    sample = stored(docs.select(F.col(id_col).alias("label_id"), F.col(text_col).alias("text")).join(F.broadcast(drawn), "label_id").select("toxic", "text"))
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = (sample.filter(F.col("toxic") == kind).select("text") for kind in (1, 0))
    contexts = toxic.mapInArrow(_contexts, "term string, context binary").groupBy("term").agg(F.countDistinct("context").alias("n"))
    least = max(LEAST_CONTEXTS, LEAST_SHARE * sizes.get(1, 0))
    counts = {r["term"]: r["n"] for r in contexts.filter(F.col("n") >= least).collect()}
    if not counts:
        forget(sample)
        return Lexicon({})
    others = clean.mapInArrow(_counted(frozenset(counts)), "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    other = {r["term"]: r["n"] for r in others.collect()}
    terms = chosen_terms({t: (n, other.get(t, 0)) for t, n in counts.items()}, sizes.get(1, 0), sizes.get(0, 0))
    every = Lexicon(terms)
    alike = clean.mapInArrow(_lookalikes(every), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    excepted = frozenset(bytes(r["word"]) for r in alike)
    by_term: Counter[str] = Counter()
    for r in alike:
        by_term[every.match(bytes(r["word"]))[0]] += r["n"] == 1
    literal = frozenset(t for t, n in by_term.items() if n > LOOKALIKES * sizes.get(0, 0))
    forget(sample)
    return Lexicon(terms, excepted, literal)


def scored(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, score, predicted``.

    The score is the logistic function of the evidence. NULL and empty texts have none and get the lowest score. A NULL
    id is not held out. Rows that repeat an id are scored each for itself; other columns are not read.
    """
    learned = lexicon.terms, lexicon.excepted, lexicon.literal

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Lexicon(*learned)
        for batch in in_parts(batches):
            scores = [score(own.evidence(text)) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    found = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, score double")
    return found.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                        (F.col("score") >= PREDICTED).cast("int").alias("predicted"))


def accepted(docs: DataFrame, lexicon: Lexicon, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    learned, place = (lexicon.terms, lexicon.excepted, lexicon.literal), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Lexicon(*learned)
        for batch in in_parts(batches):
            keep = np.array([score(own.evidence(text)) < PREDICTED for text in batch.column(0).field(place).to_pylist()], bool)
            yield batch.filter(pa.array(keep))

    # One struct, as columns may have any name.
    rows = docs.select(packed_row(docs.columns).alias("row"))
    kept = rows.mapInArrow(run, T.StructType([T.StructField("row", docs.schema)]))
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
