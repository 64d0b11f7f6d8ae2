import random

import pytest

from fieldweave.llm import graph, minhash

SCHEMA = "doc_id long, text string, row string, node int, band int, n_shingles string"


def sets(text):
    words = (text or "").encode().lower().split()
    if 0 < len(words) < 5:
        return {tuple(words)}
    return {tuple(words[n:n + 5]) for n in range(len(words) - 4)}


def brute(docs):
    found = [sets(t) for _, t in docs]
    part = list(range(len(docs)))

    def root(n):
        while part[n] != n:
            n = part[n]
        return n

    for a in range(len(docs)):
        for b in range(a):
            if found[a] and found[b]:
                both = len(found[a] & found[b])
                if 100 * both >= 75 * (len(found[a]) + len(found[b]) - both):
                    x, y = sorted((root(a), root(b)))
                    part[y] = x
    groups = {}
    for n in range(len(docs)):
        groups.setdefault(root(n), []).append(n)
    rows = []
    for members in groups.values():
        ids = [docs[n][0] for n in members]
        first = min((i for i in ids if i is not None), default=None)
        order = sorted(members, key=lambda n: (docs[n][0] is None, docs[n][0] or 0))
        rows += [(docs[n][0], len(found[n]), first, place == 0) for place, n in enumerate(order)]
    return sorted(rows, key=str)


def grouped(spark, docs):
    frame = spark.createDataFrame([(i, t, "r", 0, 0, "n") for i, t in docs], SCHEMA)
    return sorted(map(tuple, minhash.near_groups(frame).select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)


def words(rng, n):
    return [rng.choice("abcdefghijklmnopqrstuvwxyz") * rng.randint(1, 3) + str(rng.randint(0, 400)) for _ in range(n)]


def test_edges(spark):
    docs = [(7, None), (3, ""), (2, " \n"), (9, "One two"), (4, "one  TWO"), (5, "one two three"), (6, "a b c d e"), (1, "A b c d e"),
            (None, "a b c d e"), (None, "null null"), (None, "NULL null"), (12, "same same"), (12, "same same"), (13, "É a"), (14, "é a"),
            (20, "long " * 30000), (21, "long " * 29000), (22, "other words " * 20000)]
    assert grouped(spark, docs) == brute(docs)


def test_chains_and_hot_groups(spark):
    rng = random.Random(3)
    docs, passage = [], words(rng, 60)
    for n in range(25):
        base = words(rng, rng.randint(6, 150))
        for _ in range(rng.randint(1, 4)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = "edit" + str(rng.randint(0, 9))
            base = copy if rng.random() < 0.5 else base
            docs.append(" ".join(copy))
    hot = words(rng, 120)
    for n in range(120):
        copy = list(hot)
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(120)] = f"e{n}"
        docs.append(" ".join(copy))
    docs += [" ".join(passage + words(rng, rng.randint(5, 60))) for _ in range(60)]
    rng.shuffle(docs)
    docs = list(enumerate(docs))
    assert grouped(spark, docs) == brute(docs)


def pages(rng, count, frame, own):
    shared = words(rng, frame)
    return [" ".join(shared + words(rng, own)) for _ in range(count)]


def test_framed_pages(spark):
    """Pages whose frames make them similar, more and less than a link needs, with copies that have one."""
    rng = random.Random(5)
    docs = pages(rng, 40, 120, 50) + pages(rng, 30, 120, 24) + pages(rng, 30, 120, 17) + pages(rng, 20, 120, 40)
    for text in rng.sample(docs, 25):
        copy = text.split()
        for _ in range(rng.randint(1, 5)):
            copy[rng.randrange(len(copy))] = "edit"
        docs.append(" ".join(copy[rng.randint(0, 9):]))
    rng.shuffle(docs)
    docs = list(enumerate(docs))
    assert grouped(spark, docs) == brute(docs)


def test_rarest_shingles(spark):
    """All linked pairs of different components share one, with the smaller set's shorter beginning; frames pair nobody."""
    rng = random.Random(6)
    found = []
    for _ in range(60):
        base = rng.sample(range(3000), rng.randint(1, 80))
        found.append(set(base))
        found.append(set(base[rng.randint(0, len(base) // 8):] + rng.sample(range(3000), rng.randint(0, len(base) // 8))))
    frame = list(range(5000, 5100))
    framed = [set(frame + rng.sample(range(6000, 60000), 30)) for _ in range(50)]
    sets = [sorted(s) for s in found + framed]
    rows = spark.createDataFrame([(n, n, len(s), 0, 0) for n, s in enumerate(sets)], "row long, part long, n_shingles long, s1 long, s2 long")
    rarest = minhash._rarest(rows, spark.createDataFrame(list(enumerate(sets)), "row long, items array<long>")).collect()
    every, short = {}, {}
    for r in rarest:
        every.setdefault(r.row, {})[r.item] = r.place
        if r.short:
            short.setdefault(r.row, set()).add(r.item)
    links = 0
    for a in range(len(sets)):
        for b in range(len(sets)):
            both = len(set(sets[a]) & set(sets[b]))
            if a != b and len(sets[a]) <= len(sets[b]) and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                links += 1
                assert short[a] & every[b].keys()
    assert links > 50
    assert not any(i in frame for n in range(len(found), len(sets)) for i in short.get(n, ()))


def test_edited_copies(spark, monkeypatch):
    """Copies with three or four edits each are linked with what they were made from and with few others; not all their pairs meet."""
    rng = random.Random(7)
    base, docs = words(rng, 149), []
    for n in range(160):
        copy = list(base)
        for place in rng.sample(range(5, 144), rng.randint(3, 4)):
            copy[place] = f"edit{n}"
        docs.append(" ".join(copy))
    docs = list(enumerate([*docs, " ".join(base), *pages(rng, 10, 100, 40)]))
    met, compared = [], minhash._compared
    monkeypatch.setattr(minhash, "_compared", lambda pairs, sets: met.append(pairs.count()) or compared(pairs, sets))
    assert grouped(spark, docs) == brute(docs)
    assert sum(met) < 10 * len(docs)


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = minhash.near_groups(docs).select("doc_id", "n_shingles", "component_id", "kept").collect()
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(map(tuple, got), key=str) == want
    assert any(not r[3] for r in want)


def test_empty(spark):
    assert grouped(spark, []) == []


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(n, n + 1) for n in range(30)], [(0, n) for n in range(1, 40)] + [(50, 39), (60, 61), (61, 60)]])
def test_components(spark, edges):
    got = {r.u: r.v for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    parts = {}
    for u, v in edges:
        x, y = parts.setdefault(u, {u}), parts.setdefault(v, {v})
        if x is not y:
            x |= y
            parts |= dict.fromkeys(y, x)
    assert got == {n: min(p) for n, p in parts.items() if n != min(p)}
