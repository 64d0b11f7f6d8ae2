import hashlib
from collections import defaultdict
from fractions import Fraction

import pytest

from fieldweave.llm import mixing

SCHEMA = "doc_id long, text string, source string, n_chars long, size string, before int, row int, lang string"


def frame(spark, docs):
    return spark.createDataFrame([(i, t, s, len(t or ""), "x", 0, 0, "en") for i, t, s in docs], SCHEMA)


def brute(docs):
    sizes = [len((t or "").encode().split()) for _, t, _ in docs]
    sources = sorted({s for _, _, s in docs}, key=lambda s: (s is None, (s or "").encode()))
    total = {s: sum(n for n, d in zip(sizes, docs) if d[2] == s) for s in sources}
    weight = {s: (3, 1, 2)[n % 3] for n, s in enumerate(sources)}
    target, free, spare = {}, set(sources), Fraction(3, 2) * sum(sizes)
    while free:
        share = {s: spare * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if share[s] > 2 * total[s]]
        if not above:
            target |= share
            break
        for s in above:
            target[s] = Fraction(2 * total[s])
            spare -= target[s]
        free -= set(above)
    found, seen = [], defaultdict(int)
    key = lambda n: (b"" if docs[n][0] is None else hashlib.md5(str(docs[n][0]).encode()).hexdigest().encode(), docs[n][0] or -1, -n)
    for n in sorted(range(len(docs)), key=key):
        s, size = docs[n][2], sizes[n]
        left, times = int(target[s]), 0
        if total[s]:
            times, left = divmod(left, total[s])
        found.append((docs[n][0], size, total[s], float(target[s]), times * size + max(0, min(size, left - seen[s]))))
        seen[s] += size
    return sorted(found, key=str)


DOCS = [
    (1, "a b c", "x"), (2, None, "x"), (3, "", None), (4, "one two", None), (5, "w " * 900, "hot"), (6, " k l m ", "é"),
    (7, "z", "Z"), (8, "z z z z", "z"), (9, "q " * 40, "hot"), (10, "t", "hot"), (11, "n n n n n n n", ""), (12, None, "none"),
    (None, "p q", "x"),
]


def test_edges(spark):
    got = mixing.mix(frame(spark, DOCS)).drop("row").select("doc_id", "size", "source_size", "target", "taken").collect()
    want = brute(DOCS)
    assert [r[:3] + r[4:] for r in sorted(map(tuple, got), key=str)] == [r[:3] + r[4:] for r in want]
    assert [r[3] for r in sorted(map(tuple, got), key=str)] == pytest.approx([r[3] for r in want])


def test_sums_meet_targets(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = mixing.mix(docs.repartition(7)).drop("row").toPandas()
    again = mixing.mix(docs.repartition(3)).drop("row").toPandas()
    assert rows.sort_values("doc_id").reset_index(drop=True).equals(again.sort_values("doc_id").reset_index(drop=True))
    joined = rows.merge(docs.select("doc_id", "source").toPandas())
    for _, part in joined.groupby("source"):
        assert abs(part.taken.sum() - part.target.iloc[0]) < 1
    assert (rows.taken <= 2 * rows["size"]).all()
    assert abs(rows.taken.sum() - 1.5 * rows["size"].sum()) < 40


def test_repeated_rows_and_empty(spark):
    rows = mixing.mix(frame(spark, [(1, "a b", "x"), (1, "a b", "x")])).collect()
    assert [r.taken for r in rows] and sum(r.taken for r in rows) == 6 and len(rows) == 2
    assert mixing.mix(frame(spark, [])).count() == 0
    assert mixing.mix(frame(spark, [(1, None, "x")])).first().taken == 0
    assert mixing.mixed_rows(frame(spark, [])).count() == 0


def test_mixed_rows(spark):
    docs = frame(spark, DOCS)
    rows = mixing.mixed_rows(docs)
    assert rows.columns == docs.columns and rows.dtypes == docs.dtypes
    taken = {r.doc_id: r.taken for r in mixing.mix(docs).collect()}
    words = defaultdict(int)
    for r in rows.collect():
        assert r.n_chars == len(r.text)
        words[r.doc_id] += len(r.text.encode().split())
    assert dict(words) == {i: n for i, n in taken.items() if n}


def test_large_totals(spark):
    """A source of 2e13 words among 200,001: weights times words pass 64 bits."""
    big = 2 * 10 ** 13
    sizes = spark.range(200_000).selectExpr("concat('0s', lpad(id, 7, '0')) AS source_key", "10L AS source_size").union(
        spark.createDataFrame([("0a", big)], "source_key string, source_size long"))
    got = mixing.targets(sizes)
    rows = got.filter("source_size > 10").collect()
    assert [r.source_size for r in rows] == [big]
    # All others stop at twice their size; the rest of the mix is the large source's.
    assert rows[0].target == 1.5 * (big + 2_000_000) - 4_000_000
    assert got.filter("source_size = 10 AND target = 20").count() == 200_000
