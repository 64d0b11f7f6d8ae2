import hashlib
import re
from collections import defaultdict

from fieldweave.llm import radix

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, keep_id string, kept int, part int, digit int"
LONG = "word and " * 40000


def brute(docs):
    groups = defaultdict(list)
    for doc_id, text in docs:
        groups[re.sub(r"[ \t-\r]+", " ", text or "")].append(doc_id)
    found = []
    for text, ids in groups.items():
        named = [i for i in ids if i is not None]
        keep = min(named) if named else None
        digest = hashlib.sha256(text.encode()).hexdigest()
        stays = sorted(ids, key=lambda i: (i is None, i or 0))
        found += [(i, keep, len(ids), n == 0, digest) for n, i in enumerate(stays)]
    return sorted(found, key=str)


CASES = [
    (5, "a b"), (3, "a  b"), (9, "a\t\nb"), (1, "a b "), (2, None), (4, ""), (6, LONG), (7, LONG), (8, LONG + "x"),
    (10, LONG[:64]), (11, LONG[:64]), (12, LONG[:63]), (13, LONG[:512]), (14, LONG[:512]), (15, "é" * 40), (16, "é" * 40),
    (17, "é" * 40), (18, " "), (19, "  "), (None, "lost"), (None, "lost"), (20, "lost"), (None, "alone"), (None, "pair"),
    (None, "pair"), (21, "same"), (21, "same"), (22, "a b"), (23, "A b"), (30, "x" * 256 + "tail"), (30, "y" * 256 + "tail"),
    (31, "x" * 256 + "tail"), (32, "y" * 256 + "tail"), (33, LONG[:256]), (34, LONG[:256]), (35, LONG[:2304]), (36, LONG[:2304]),
]


def test_edges(spark):
    docs = spark.createDataFrame([(i, t, None, "s", 0, "c", 1, 2, 3) for i, t in CASES], SCHEMA)
    got = radix.exact_groups(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted(map(tuple, got), key=str) == brute(CASES)


def test_kept_rows_keep_columns(spark):
    docs = spark.createDataFrame([(i, t, None, "s", 0, "c", 1, 2, 3) for i, t in CASES], SCHEMA)
    kept = radix.kept_rows(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({re.sub(r"[ \t-\r]+", " ", t or "") for _, t in CASES})


def test_empty(spark):
    assert radix.exact_groups(spark.createDataFrame([], SCHEMA)).count() == 0


def test_hot_group(spark):
    docs = [(i, LONG if i % 3 else f"{LONG}{i}") for i in range(60)]
    got = radix.exact_groups(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(map(tuple, got.drop("row").collect()), key=str) == brute(docs)
