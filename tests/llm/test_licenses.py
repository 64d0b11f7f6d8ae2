import re

from fieldweave.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fits(words, own, begin, end, places):
    """Whether the words of a span are the template's, but for words put in or left out that change nothing."""
    family = next((m for m in licenses.FAMILIES.values() if any(t.split() == own for t, _ in m)), [])
    others = [set(t.split()) for t, _ in family if t.split() != own]
    span = set(words[begin:end])
    return (places == sorted(places) and end - begin <= len(own) + 4
            and all(w in span for w in own if any(w not in o for o in others))
            and not any(w in span for o in others for w in o - set(own)))


def brute(text):
    """Base columns, and the labels and score of a plain scan along each diagonal."""
    words = WORD.findall((text or "").translate(LOWER))
    starts, base, labels, score = [], set(), set(), 0.0
    for n, (phrase, label) in enumerate(licenses.PHRASES + licenses.TEMPLATES):
        own = phrase.split()
        votes = {}
        for pos in range(len(words) - 1):
            for at in range(len(own) - 1):
                if words[pos:pos + 2] == own[at:at + 2]:
                    votes.setdefault(pos - at, set()).add((pos, at))
        runs = []
        for diagonal in sorted(votes):
            if n >= len(licenses.PHRASES) and runs and diagonal - runs[-1][0] <= licenses.SLACK:
                runs[-1] = (diagonal, runs[-1][1] | votes[diagonal])
            else:
                runs.append((diagonal, votes[diagonal]))
        for diagonal, seen in runs:
            share = len({at for _, at in seen}) / (len(own) - 1)
            score = max(score, share)
            if n < len(licenses.PHRASES):
                if share == 1:
                    starts.append(diagonal)
                    base.add(label)
                    labels.add(label)
            elif share >= licenses.COVERED:
                places = [pos for pos, _ in seen]
                if fits(words, own, min(places), max(places) + 2, [at for _, at in sorted(seen)]):
                    labels.add(label)
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score)


COLUMNS = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
APACHE = "Licensed under the Apache License, Version 2.0."
CASES = [
    None, "", " -- ", "CC BY", "cc", "by cc by cc-by", "ALL rights\nreserved all rights reserved", "all rights all rights reserved",
    APACHE, "Licensed under the very Apache License, Version 2.0", "Licensed under Apache License Version 2.0 x",
    "This work is licensed under the GNU General Public License, version 3.", "general public license" * 3, "Écc by éé cc BY",
    "x " * 30000 + "cc by", (APACHE + " ") * 50, "general public", "Licensed under CC BY-NC 4.0.", "ſ K cc by",
    "a" * 100000, "\x00cc\x7fby\x80", "cc byé", "𝒞 cc by 𝒞",
]


def test_edges(spark):
    docs = spark.createDataFrame([(None if n == 3 else n // 2, t, "l", 1) for n, t in enumerate(CASES)], "doc_id long, text string, label string, row int")
    got = licenses.scan(docs).select("doc_id", *COLUMNS).collect()
    want = [(None if n == 3 else n // 2, *brute(t)) for n, t in enumerate(CASES)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_spans(spark):
    docs = spark.createDataFrame([(1, "z " + APACHE)], "doc_id long, text string")
    assert [tuple(s) for s in licenses.scan(docs).first().spans] == [(1, 8, "apache-2.0", 1.0)]


def test_empty(spark):
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in licenses.scan(docs).collect()}
    assert got == {r.doc_id: brute(r.text) for r in docs.collect()}
    assert any(r[1] for r in got.values())


def test_native(spark, folder):
    plan = licenses.scan(spark.read.parquet(f"{folder}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "BroadcastHashJoin" in plan


CC = [(name, version) for name in ("by", "by-nc", "by-sa", "by-nd", "by-nc-sa", "by-nc-nd") for version in ("4.0", "3.0")]
LONG = {"by": "Attribution", "nc": "NonCommercial", "sa": "ShareAlike", "nd": "NoDerivatives"}


def by_meaning():
    """Notices as people write them, each with the labels that it means; from the notice, not from the rule."""
    for name, version in CC:
        spoken = "-".join(LONG[e] for e in name.split("-"))
        kind = "International" if version == "4.0" else "Unported"
        label = f"cc-{name}-{version}"
        yield f"Licensed under CC {name.upper()} {version}.", {"cc-by", label}
        yield f"(c) me. Licensed under CC-{name.upper()}-{version}, see below", {"cc-by", label}
        yield f"This work is licensed under a Creative Commons {spoken} {version} {kind} License.", {label}
        yield f"This work is licensed under a nice Creative Commons {spoken} {version} {kind} License.", {label}
    yield "Licensed under CC BY 2.0", {"cc-by"}
    yield "CC BY-NC 4.0", {"cc-by"}
    yield "licensed by 4.0 people under cc", set()
    yield "This work is licensed under the GNU General Public License, version 3.", {"gpl", "gpl-3.0"}
    yield "This work is licensed under the GNU General Public License, version 2.", {"gpl", "gpl-2.0"}
    yield "This work is licensed under the GNU Lesser General Public License, version 3.", {"gpl", "lgpl-3.0"}
    for word, label in (("", "gpl"), ("Lesser ", "lgpl"), ("Affero ", "agpl")):
        yield f"under the terms of the GNU {word}General Public License as published by the Free Software Foundation", {"gpl", label}
    for version, label in (("2.0", "epl-2.0"), ("v1.0", "epl-1.0")):
        yield f"This program and the accompanying materials are made available under the terms of the Eclipse Public License {version}", {label}
    yield "This is free and unencumbered software released into the public domain.", {"unlicense"}
    yield APACHE, {"apache-2.0"}
    yield "Licensed under the well known Apache License, Version 2.0", {"apache-2.0"}
    yield "License Apache the under licensed 2.0 version", set()


def test_labels_mean_what_they_say(spark):
    cases = list(by_meaning())
    docs = spark.createDataFrame([(n, f"Some words before. {t} And some after, of no license.") for n, (t, _) in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: set(filter(None, r.labels.split(","))) for r in licenses.scan(docs).collect()}
    assert {cases[n][0]: labels for n, labels in got.items()} == dict(cases)


def test_notices_of_the_documents(spark):
    """A notice with an element never gets the label of the license without it."""
    rows = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter("text ilike '%cc by-nc%'")
    got = licenses.scan(rows).collect()
    assert len(got) > 20 and all("cc-by-nc-4.0" in r.labels.split(",") and "cc-by-4.0" not in r.labels.split(",") for r in got)
