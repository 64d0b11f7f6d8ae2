import itertools
import random
import re
import zlib

from fieldweave.llm import toxicity
from fieldweave.llm.toxicity import Lexicon

TERMS = {"idiot": (False, 6.0), "scum": (False, 6.0), "vequ": (True, 6.0), "moron": (False, 6.0), "weaker": (False, 5.0)}


def distance(a, b):
    """Edits, with swaps of neighbours."""
    rows = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i, j in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
        rows[i, j] = min(rows[i - 1, j] + 1, rows[i, j - 1] + 1, rows[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
        if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
            rows[i, j] = min(rows[i, j], rows[i - 2, j - 2] + 1)
    return rows[len(a), len(b)]


def test_automaton_against_distance():
    lexicon, rng = Lexicon(TERMS), random.Random(1)
    words = set(TERMS)
    for term in TERMS:
        for _ in range(400):
            word = list(term)
            for _ in range(rng.randint(1, 2)):
                at = rng.randrange(len(word)) if word else 0
                rng.choice([lambda: word.insert(at, rng.choice("idotscumvx")), lambda: word and word.pop(at),
                            lambda: word and word.__setitem__(at, rng.choice("idotscumvx")),
                            lambda: len(word) > at + 1 and word.__setitem__(slice(at, at + 2), word[at:at + 2][::-1])])()
            words.add("".join(word))
    for word in words - {""}:
        stem = next((t for t, (s, _) in TERMS.items() if s and word.startswith(t)), None)
        if stem:
            want = (stem, False)
        else:
            near = [(distance(word, t), t) for t, (s, _) in TERMS.items() if not s]
            near = [(d, t) for d, t in near if d == 0 or (d == 1 and t in lexicon.fuzzy)]
            want = (min(near)[1], bool(min(near)[0])) if near else None
        assert lexicon.match(word.encode()) == want, word


def test_context():
    lexicon = Lexicon(TERMS)
    s = lambda text: toxicity.score(lexicon.evidence(text))
    assert s("you IDIOT!") >= 0.3 and s("you idoit") >= 0.3 and s("Vequille dans") >= 0.3
    assert s('he wrote "idiot" there') < 0.3 and s("the word idiot is old") < 0.3 and s("« idiot » dit il") < 0.3
    assert s('"hello" you idiot "bye"') >= 0.3
    assert s(None) == s("") == s("fine words") < 0.05
    assert Lexicon(TERMS, frozenset([b"oron"])).match(b"oron") is None and lexicon.match(b"oron") == ("moron", True)


def test_terms():
    counts = {"lose": (50, 0), "loser": (50, 0), "loser ": (50, 0), "lowe": (40, 0), "lowei": (40, 0), "loweis": (20, 0), "loweisch ": (9, 0), "the ": (90, 900), "anti": (30, 0), "antix ": (30, 0), "rare ": (2, 0)}
    found = toxicity.chosen_terms(counts, 100, 1000)
    assert {t: stem for t, (stem, _) in found.items()} == {"loser": False, "lowei": True, "antix": False}


def labelled(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")


def test_held_out_accuracy(spark):
    docs, labels = labelled(spark, "/root/testdata/sf0.1")
    lexicon = toxicity.learn(docs, labels)
    rows = toxicity.scored(docs, lexicon).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    rows = [r for r in rows if r.held_out]
    caught = sum(r.predicted for r in rows if r.toxic) / sum(r.toxic for r in rows)
    wrong = sum(r.predicted for r in rows if not r.toxic) / sum(1 - r.toxic for r in rows)
    assert caught > 0.9 and wrong < 0.02
    kept = toxicity.accepted(docs, lexicon)
    assert kept.columns == docs.columns and kept.count() == toxicity.scored(docs, lexicon).filter("predicted = 0").count()


def test_labels_of_held_out_rows_are_not_read(spark, folder):
    from pyspark.sql import functions as F

    docs, labels = labelled(spark, folder)
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.learn(docs, labels).terms == toxicity.learn(docs, turned).terms


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, "x", 0.5), (None, "", "x", 0.1), (2, "scum " * 50000, "x", 0.2), (2, "scum", "x", 0.1)], "doc_id long, text string, toxic string, score double")
    rows = toxicity.scored(docs, Lexicon(TERMS)).collect()
    assert len(rows) == 4 and sum(r.predicted for r in rows) == 2 and all(0 <= r.score <= 1 for r in rows)
    none = spark.createDataFrame([], "doc_id long, toxic int, text string")
    assert toxicity.learn(docs, none).terms == {} and toxicity.scored(none, Lexicon(TERMS)).count() == 0
    labels = spark.createDataFrame([(None, 1), (1, None), (1, 0), (2, 1), (2, 0)], "doc_id long, toxic int")
    assert toxicity.accepted(docs, toxicity.learn(docs, labels)).count() == 4


def test_misspelled_stems():
    """Words that begin with a stem but for one edit, against distances of their beginnings; excepted words stay out."""
    lexicon, rng = Lexicon({"vequx": (True, 6.0), "idiot": (False, 6.0)}), random.Random(2)
    assert lexicon.match(b"vequxille") == ("vequx", False)
    for word in ("vqeuxille", "veuxille", "vequuxille", "vebuxille", "bequxille"):
        assert lexicon.match(word.encode()) == ("vequx", True), word
    assert toxicity.score(lexicon.evidence("vous vqeuxille")) >= 0.3
    assert Lexicon(lexicon.terms, frozenset([b"vqeuxille"])).match(b"vqeuxille") is None
    for _ in range(3000):
        word = "".join(rng.choice("vequx") for _ in range(rng.randint(1, 8)))
        if not word.startswith("vequx"):
            want = any(distance(word[:n], "vequx") <= 1 for n in range(len(word) + 1))
            assert lexicon.match(word.encode()) == (("vequx", True) if want else None), word


def test_fuzzy_terms_do_not_depend_on_sample_size():
    shares = {"brutex": (0.04, 0), "gromulo ": (0.03, 0), "vastok ": (0.02, 0), "maybe ": (0.05, 0.0008), "rather ": (0.05, 0.0008), "mostly ": (0.05, 0.0008)}
    found = []
    for toxic, clean in ((3000, 1200), (3000, 2650), (3000, 12000)):
        counts = {t: (round(p * toxic), round(q * clean)) for t, (p, q) in shares.items()}
        terms = toxicity.chosen_terms(counts, toxic, clean)
        assert len(terms) == 6
        found.append(Lexicon(terms).fuzzy)
    assert found[0] == found[1] == found[2] == {"brutex", "gromulo", "vastok"}


def test_quoted_mentions_of_clean_texts_are_not_counted():
    wanted = frozenset(["moron ", "moro", "fine "])
    assert toxicity._used('he wrote "moron" and it was fine', wanted) == {"fine "}
    assert toxicity._used("the word moron is quite fine", wanted) == {"fine "}
    assert toxicity._used('"moron" was written there, you moron', wanted) == {"moron ", "moro"}
    assert toxicity._used(None, wanted) == toxicity._used('""', wanted) == set()


def test_long_quotations_and_other_marks():
    lexicon = Lexicon(TERMS)
    s = lambda text: toxicity.score(lexicon.evidence(text))
    far = "fine words without end" + " and more of them" * 20
    assert s(f'he wrote "{far} you idiot {far}" there') < 0.3 and s(f"„{far} idiot {far}“ schrieb er") < 0.3
    assert s("he wrote “idiot” there") < 0.3 and s("‘I don’t like an idiot’ is what was heard") < 0.3
    assert s('he wrote " idiot " there') < 0.3 and s("他说\"idiot\"吗") < 0.3
    assert s("you idiot… go") >= 0.3 and s("idiot—you") >= 0.3 and s("¡idiot!") >= 0.3
    # Inches, marks without a partner and closed quotations do not cover what follows.
    assert s('a 5" pipe, you idiot, and a 6" one') >= 0.3 and s("“ you idiot") >= 0.3 and s('"hello" you idiot') >= 0.3
    assert s("İİİ “fine” idiot") >= 0.3 and s("İİİ “fine idiot”") < 0.3


def test_words_of_any_length_are_terms():
    words = toxicity._features([b"ab", b"you", b"abcde", b"ab"])
    assert words == {"ab ": b"", "you ": b"ab", "abcde ": b"you", "abcd": b"you", "abcde": b"you"}
    terms = toxicity.chosen_terms({"ab ": (50, 0), "the ": (90, 900)}, 100, 1000)
    assert set(terms) == {"ab"} and not terms["ab"][0]
    assert toxicity.score(Lexicon(terms).evidence("you ab")) >= 0.3 and Lexicon(terms).match(b"aab") is None
    many = {f"term{n} ": (50, 0) for n in range(5000)}
    assert len(toxicity.chosen_terms(many, 100, 1000)) == 5000


def closing(text, at):
    """By the text around a mark: none closes before an ASCII word, nor after a blank unless another blank follows."""
    return text[at] not in '"`’' or not re.match(r"[a-z0-9]", text[at + 1:]) and not (re.search(r"(^|\s)$", text[:at]) and re.match(r"\S", text[at + 1:]))


def plain_evidence(lexicon, text):
    """The definition: each word against every term by edit distance, each character under its outermost quotation."""
    text = (text or "").lower()
    inside, partner, opened = [False] * len(text), None, 0
    for at, c in enumerate(text):
        before, after = text[max(0, at - 1):at], text[at + 1:at + 2]
        if partner:
            if c == partner and closing(text, at):
                inside[opened:at] = [True] * (at - opened)
                partner = None
        elif c in toxicity.QUOTES:
            glued = before.isascii() and before.isalnum()
            ends = not before.isspace() and before != "" and (after.isspace() or after == "")
            if not (toxicity.QUOTES[c] == c and (glued or ends)):
                want = toxicity.QUOTES[c]
                if any(text[n] == want and closing(text, n) for n in range(at + 1, len(text))):
                    partner, opened = want, at
    words = [(m.start(), m.group()) for m in re.finditer(r"[^\W_]+", text)]
    best = {}
    for n, (at, word) in enumerate(words):
        stems = [t for t, (stem, _) in lexicon.terms.items() if stem and word.startswith(t)]
        near = []
        for term, (stem, _) in lexicon.terms.items():
            edits = min(distance(word[:k], term) for k in range(len(word) + 1)) if stem else distance(word, term)
            if edits == 0 or (edits == 1 and term in lexicon.fuzzy and word.encode() not in lexicon.excepted):
                near.append((edits, term))
        if stems or near:
            edits, term = (0, stems[0]) if stems else min(near)
            aside = inside[at] or any(w in toxicity.ABOUT for _, w in words[max(0, n - 3):n])
            weight = lexicon.terms[term][1] * (0.7 if edits else 1) * (0.2 if aside else 1)
            best[term] = max(best.get(term, 0.0), weight)
    return sum(best.values())


def test_score_against_its_definition(spark):
    lexicon, rng = Lexicon(TERMS | {"ab": (False, 4.0)}, frozenset([b"oron"])), random.Random(5)
    bits = ["idiot", "idoit", "scum", "scam", "vequille", "vqeu", "moron", "oron", "weaker", "ab", "the", "word", "said", "fine", "don’t", "5\"", '"', "“", "”",
            "„", "«", "»", "‘", "’", "`", ". ", "… ", " ", "\n"]
    texts = ["".join(rng.choice(bits) + rng.choice(["", " ", " ", ", "]) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in toxicity.scored(docs, lexicon).collect():
        want = plain_evidence(lexicon, texts[row.doc_id])
        assert abs(row.score - toxicity.score(want)) < 1e-12 and row.predicted == (row.score >= 0.3), texts[row.doc_id]
