import math

import numpy as np

from fieldweave.llm import vectors

SCHEMA = "vec_id long, embedding array<float>, label int, node string, n int, block int"


def brute(rows, threshold=0.95):
    valid = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(x for x in v) for _, v in rows]
    units = [np.array(v, np.float32).astype(float) / np.linalg.norm(np.array(v, np.float32).astype(float)) if ok else None for ok, (_, v) in zip(valid, rows)]
    part, links = list(range(len(rows))), [0] * len(rows)

    def root(n):
        while part[n] != n:
            n = part[n]
        return n

    for a in range(len(rows)):
        for b in range(a):
            if valid[a] and valid[b] and len(units[a]) == len(units[b]) and units[a] @ units[b] >= threshold:
                links[a] += 1
                links[b] += 1
                x, y = sorted((root(a), root(b)))
                part[y] = x
    groups = {}
    for n in range(len(rows)):
        groups.setdefault(root(n), []).append(n)
    found = []
    for members in groups.values():
        first = min((rows[n][0] for n in members if rows[n][0] is not None), default=None)
        order = sorted(members, key=lambda n: (rows[n][0] is None, rows[n][0] or 0))
        found += [(rows[n][0], links[n], first, place == 0) for place, n in enumerate(order)]
    return sorted(found, key=str)


def grouped(spark, rows):
    frame = spark.createDataFrame([(i, v, 1, "x", 2, 3) for i, v in rows], SCHEMA)
    return sorted(map(tuple, vectors.near_groups(frame).select("vec_id", "n_links", "component_id", "kept").collect()), key=str)


def test_edges(spark):
    rows = [
        (9, [1.0, 0.0, 0.0]), (3, [2.0, 0.0, 0.0]), (5, [1.0, 0.1, 0.0]), (4, None), (6, []), (7, [0.0, 0.0, 0.0]), (8, [1.0, None, 0.0]),
        (10, [float("nan"), 1.0, 0.0]), (11, [float("inf"), 0.0, 0.0]), (12, [1.0, 0.0]), (13, [1.0, 0.0]), (14, [-1.0, 0.0, 0.0]),
        (15, [0.0, 1e-30, 0.0]), (16, [0.0, 1e30, 0.0]), (16, [0.0, 1e30, 0.0]), (None, [1.0, 0.0, 0.0]), (None, [0.0, 0.0, 1.0]), (17, [5.0]), (18, [-0.0, -0.0, -3.0]),
    ]
    assert grouped(spark, rows) == brute(rows)


def test_empty(spark):
    assert grouped(spark, []) == []


def test_groups(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 64)
    monkeypatch.setattr(vectors, "TILE", 32)
    rng = np.random.default_rng(5)
    rows = []
    for size in (1, 2, 5, 150):
        for _ in range(200 // size):
            center = rng.normal(size=24)
            rows += [(center + rng.normal(size=24) * rng.choice([0.0, 0.1, 0.25])).astype(np.float32).tolist() for _ in range(size)]
    rng.shuffle(rows)
    rows = [(n, list(map(float, v))) for n, v in enumerate(rows)]
    assert grouped(spark, rows) == brute(rows)


def test_embeddings(spark, folder):
    frame = spark.read.parquet(f"{folder}/embeddings.parquet")
    got = sorted(map(tuple, vectors.near_groups(frame).select("vec_id", "n_links", "component_id", "kept").collect()), key=str)
    assert got == brute([(r.vec_id, r.embedding) for r in frame.collect()])


def test_open_pairs():
    rng = np.random.default_rng(1)
    for spread in (0.05, 1.0):
        a = rng.normal(size=70) + spread * rng.normal(size=(90, 70))
        a /= np.linalg.norm(a, axis=1)[:, None]
        for threshold in (0.3, 0.95, 0.999):
            want = np.nonzero(a @ a.T >= threshold)
            assert all((x == y).all() for x, y in zip(vectors.open_pairs(a, a, threshold), want))
