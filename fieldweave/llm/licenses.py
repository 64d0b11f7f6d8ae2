"""License scans by diagonal voting, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Phrases that the base scan looks for, with their labels.
PHRASES = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]

# Openings of public licenses, as words, with the labels that the voting adds. The families hold licenses whose openings
# differ by single words only.
FAMILIES = {
    "gnu work": [
        ("this work is licensed under the gnu general public license version 3", "gpl-3.0"),
        ("this work is licensed under the gnu general public license version 2", "gpl-2.0"),
        ("this work is licensed under the gnu lesser general public license version 3", "lgpl-3.0"),
        ("this work is licensed under the gnu affero general public license version 3", "agpl-3.0"),
    ],
    "gnu terms": [
        ("under the terms of the gnu general public license as published by the free software foundation", "gpl"),
        ("under the terms of the gnu lesser general public license as published by the free software foundation", "lgpl"),
        ("under the terms of the gnu affero general public license as published by the free software foundation", "agpl"),
    ],
    "apache": [("licensed under the apache license version 2 0", "apache-2.0")],
    "mit": [("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
             "documentation files", "mit")],
    "bsd": [("redistribution and use in source and binary forms with or without modification are permitted provided that the "
             "following conditions are met", "bsd")],
    "isc": [("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
             "granted", "isc")],
    "mpl": [("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0")],
    "epl": [
        ("this program and the accompanying materials are made available under the terms of the eclipse public license 2 0", "epl-2.0"),
        ("this program and the accompanying materials are made available under the terms of the eclipse public license v1 0", "epl-1.0"),
    ],
    "unlicense": [("this is free and unencumbered software released into the public domain", "unlicense")],
    "cc0": [("the person who associated a work with this deed has dedicated the work to the public domain", "cc0-1.0")],
}

# The six attribution licenses: the elements of each, short and in words, in two versions.
ELEMENTS = {"by": "", "by-nc": "noncommercial", "by-sa": "sharealike", "by-nd": "noderivatives",
            "by-nc-sa": "noncommercial sharealike", "by-nc-nd": "noncommercial noderivatives"}
VERSIONS = {"4.0": "international", "3.0": "unported"}
FAMILIES |= {
    "cc": [(f"licensed under cc {name.replace('-', ' ')} {version.replace('.', ' ')}", f"cc-{name}-{version}")
           for version in VERSIONS for name in ELEMENTS],
    "cc long": [(" ".join(f"this work is licensed under a creative commons attribution {words} {version.replace('.', ' ')} {kind} license".split()),
                 f"cc-{name}-{version}") for version, kind in VERSIONS.items() for name, words in ELEMENTS.items()],
}
TEMPLATES = [template for family in FAMILIES.values() for template in family]


def telling_words(templates=tuple(TEMPLATES)) -> list[tuple[list[str], list[str]]]:
    """For each template the words that it must have and those it must not: what tells it and its family apart."""
    family = {template: name for name, members in FAMILIES.items() for template in members}
    found = []
    for template in templates:
        own = set(template[0].split())
        others = [set(t[0].split()) for t in templates if t != template and family.get(t, t) == family.get(template, template)]
        found.append((sorted({w for o in others for w in own - o}), sorted({w for o in others for w in o - own})))
    return found


#: Words in a gram. The shortest phrase has two.
GRAM = 2
#: Diagonals at most so far apart are one occurrence with words put in or left out.
SLACK = 2
#: The share of a template's grams that an occurrence must have, and the words that it may be longer than the template.
COVERED, LONGER = 0.8, 4

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def license_words(text: Column) -> Column:
    """Letters, digits and everything outside ASCII, with A-Z in lower case; NULL has no words."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), GAPS), "")


def grams(words: Column) -> Column:
    """The words with the one that follows each, and an end mark."""
    marked = F.concat(words, F.array(F.lit(None).cast("string")))
    return F.arrays_zip(marked.alias("first"), F.slice(marked, 2, F.size(marked)).alias("second"))


def template_grams(spark: SparkSession, phrases=tuple(PHRASES), templates=tuple(TEMPLATES)) -> DataFrame:
    """``template, label, base, needed, barred, grams, at, first, second, hash`` of each gram; as many rows as the lists have words."""
    telling = [([], []) for _ in phrases] + telling_words(templates)
    rows = [(n, label, base, text, *telling[n]) for n, (text, label, base) in enumerate(
        [(*p, True) for p in phrases] + [(*t, False) for t in templates])]
    layout = "template int, label string, base boolean, text string, needed array<string>, barred array<string>"
    made = spark.createDataFrame(rows, layout).withColumn("words", F.split("text", " "))
    return (
        made.select("template", "label", "base", "needed", "barred", (F.size("words") - 1).alias("grams"), F.posexplode(grams(F.col("words"))).alias("at", "gram"))
        .filter("at < grams").select("template", "label", "base", "needed", "barred", "grams", "at", F.col("gram")["first"].alias("t_first"),
                                     F.col("gram")["second"].alias("t_second"), F.xxhash64("gram.first", "gram.second").alias("t_hash"))
    )


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=tuple(PHRASES), templates=tuple(TEMPLATES)) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans``.

    Hashes of all grams of all texts are joined with the template grams; a join row votes for the diagonal on which it
    lies (place in the text less place in the template) if its words, not only their hashes, are equal. A phrase stands
    where its diagonal has all its votes. For templates, neighbouring diagonals are merged, so that a word put in or
    left out does not lose the occurrence. A merged span that has ``COVERED`` of the template's grams is verified against
    its words: grams in the template's order, no more than ``LONGER`` words longer, every word that tells the template
    from others of its family, and none that tells another one from it.
    ``spans`` are the occurrences (label, first word, words, share of grams); ``score`` is the largest share of grams of
    any occurrence, counted ones or not.

    The template grams are broadcast: they are the fixed lists above. Everything after the join has one row per text
    and match; a text and its matches meet by the number of its row, so NULL and repeated ids do no harm. NULL and empty
    texts have no words, score 0 and empty label lists. No rows give no rows; other columns are not read.
    """
    known = F.broadcast(template_grams(docs.sparkSession, phrases, templates))
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), license_words(F.col(text_col)).alias("words"))
    at = texts.select("row", "doc_id", F.size("words").cast("long").alias("n"), "words", F.posexplode(grams(F.col("words"))).alias("pos", "gram"))
    at = at.select("row", "doc_id", "n", "words", "pos", F.col("gram")["first"].alias("first"), F.col("gram")["second"].alias("second"))
    found = at.withColumn("hash", F.xxhash64("first", "second")).join(
        known, (F.col("hash") == F.col("t_hash")) & (F.col("first") == F.col("t_first")) & (F.col("second") == F.col("t_second")), "left")
    # A vote for a template brings the words that its span can have from there on.
    ahead = F.when(~F.col("base"), F.slice("words", F.col("pos") + 1, F.col("grams") + 1 + LONGER))
    found = found.filter("template is not null or first is null").select(
        "row", "doc_id", F.when(F.col("template").isNull(), F.col("n")).alias("n_words"), "template", "label", "base", "needed", "barred", "grams",
        "pos", "at", (F.col("pos") - F.col("at")).alias("diagonal"), ahead.alias("ahead")).repartition("row")
    own = ["row", "doc_id", "n_words", "template", "label", "base", "needed", "barred", "grams"]
    votes = found.groupBy(*own, "diagonal").agg(
        F.collect_set(F.struct("pos", "at")).alias("seen"), F.min("pos").alias("start"), F.max("pos").alias("end"),
        F.min_by("ahead", "pos").alias("ahead"))
    by_template = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(by_template) > SLACK, F.lit(True)) | F.col("base")
    runs = votes.withColumn("new", apart.cast("int")).withColumn("run", F.sum("new").over(by_template))
    merged = runs.groupBy(*own, "run").agg(
        F.array_sort(F.flatten(F.collect_list("seen"))).alias("seen"), F.min("start").alias("start"),
        (F.max("end") + GRAM).alias("end"), F.min_by("ahead", "start").alias("ahead"))
    places = F.transform("seen", lambda vote: vote["at"])
    merged = merged.withColumn("votes", F.size(F.array_distinct(places)))
    span = F.slice("ahead", F.lit(1), F.col("end") - F.col("start"))
    verified = (
        (F.array_sort(places) == places) & (F.col("end") - F.col("start") <= F.col("grams") + 1 + LONGER)
        & (F.size(F.array_except("needed", span)) == 0) & ~F.arrays_overlap("barred", span))
    share = F.col("votes") / F.col("grams")
    whole = F.col("base") & (F.col("votes") == F.col("grams"))
    held = whole | (~F.col("base") & (share >= COVERED) & verified)
    return merged.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.count_if(whole).alias("n_base"),
        F.min(F.when(whole, F.col("start").cast("long"))).alias("first_word"), F.max(F.when(whole, F.col("start").cast("long"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(whole, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(F.when(held, F.col("label")))), ",").alias("labels"),
        F.coalesce(F.max(share), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(held, F.struct(
            F.col("start"), (F.col("end") - F.col("start")).alias("words"), F.col("label"), share.alias("share"))))).alias("spans"),
    ).drop("row")
