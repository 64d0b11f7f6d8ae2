import hashlib
import random
from collections import defaultdict

import pytest

from fieldweave.llm import debruijn


def brute(docs):
    last, first = 2**63 - 1, {}
    for doc_id, text in docs:
        words, did = (text or "").encode().split(), last if doc_id is None else doc_id
        for n in range(len(words) - 12):
            key = tuple(words[n:n + 13])
            first[key] = min(first.get(key, did), did)
    rows = []
    for doc_id, text in docs:
        words, did = (text or "").encode().split(), last if doc_id is None else doc_id
        gone = set()
        for n in range(len(words) - 12):
            if first[tuple(words[n:n + 13])] < did:
                gone.update(range(n, n + 13))
        kept = b" ".join(w for n, w in enumerate(words) if n not in gone)
        rows.append((doc_id, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(rows, key=str)


def passages(spark, docs, **options):
    frame = spark.createDataFrame([(i, t, "r", 0, "f", 1) for i, t in docs], "doc_id long, text string, row string, first int, sha string, did int")
    return sorted(map(tuple, debruijn.shared_passages(frame, **options).drop("spans").collect()), key=str)


def words(rng, n, kinds=300):
    return [f"w{rng.randrange(kinds)}" for _ in range(n)]


def test_passages(spark):
    rng = random.Random(4)
    shared = [words(rng, n) for n in (12, 13, 14, 30, 80)]
    docs = []
    for n in range(150):
        own = words(rng, rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(own))
            part = rng.choice(shared)
            cut = rng.randint(0, 3)
            own[at:at] = part[cut:] if rng.random() < 0.3 else part
        docs.append((n * 7 % 150, " ".join(own)))
    docs += [(200 + n, " ".join(shared[4] + words(rng, 5))) for n in range(40)]
    docs += [(300 + n, docs[3][1]) for n in range(30)]
    rng.shuffle(docs)
    assert passages(spark, docs) == brute(docs)


@pytest.mark.parametrize("bits", [3, 9, 13])
def test_colliding_edges(spark, bits):
    """Hashes of few bits, so that edges stand for several windows and runs differ from their source."""
    rng = random.Random(bits)
    shared = [words(rng, n) for n in (13, 20, 60)]
    docs = []
    for n in range(60):
        own = words(rng, rng.randint(0, 30))
        for _ in range(rng.randint(0, 2)):
            at = rng.randint(0, len(own))
            own[at:at] = rng.choice(shared)[rng.randint(0, 6):]
        docs.append((n * 7 % 60, " ".join(own)))
    docs += [(None, " ".join(shared[2])), (3, " ".join(shared[1] + shared[0])), (3, "x")]
    assert passages(spark, docs, edge_bits=bits) == brute(docs)


def test_few_words(spark):
    """Texts of two different words branch everywhere."""
    rng = random.Random(8)
    docs = [(n, " ".join(words(rng, rng.randint(0, 50), 2))) for n in range(60)]
    assert passages(spark, docs) == brute(docs)


def test_edges(spark):
    long = "a b c " * 20000
    docs = [(5, None), (4, ""), (3, " \n "), (2, long), (1, long + "d"), (6, "x " * 13), (7, "x " * 12), (8, "x " * 14), (9, "X " * 13),
            (None, "x " * 30), (None, "y " * 30), (None, "y " * 30), (10, "z " * 20), (10, "z " * 20), (10, "z " * 40), (11, "é " * 13), (12, "é\t" * 13)]
    assert passages(spark, docs) == brute(docs)


def test_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = sorted(map(tuple, debruijn.shared_passages(docs).drop("spans").collect()), key=str)
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert any(r[2] for r in got)


def test_spans_and_empty(spark):
    docs = [(1, "k l m " + "p " * 20), (2, "q " + "p " * 20 + "r")]
    rows = {r.doc_id: r for r in debruijn.shared_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert [tuple(s) for s in rows[2].spans] == [(1, 20)] and rows[1].spans == []
    assert passages(spark, []) == []


def test_paths(spark):
    rows = [(1, 7, 0, 2, 2), (2, 7, 1, 3, 3), (3, 7, 2, 4, 9), (4, 7, 3, 5, 5), (5, 7, 4, 0, 0), (6, 8, 5, 2, 2), (9, 8, 9, 0, 0)]
    found = debruijn.paths(spark.createDataFrame(rows, "edge long, first long, source long, least int, most int")).collect()
    starts = defaultdict(set)
    for r in found:
        starts[r.first, r.path].add(r.edge)
    assert set(map(frozenset, starts.values())) == {frozenset(x) for x in ({1}, {2, 3}, {4, 5}, {6}, {9})}
