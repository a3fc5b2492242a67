"""License phrases and templates in blocks of text: an exact set-similarity join with built-in functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Notices to look for, with the label of each.
TEMPLATES = {
    "licensed under the apache license version 2 0": "apache-notice",
    "this work is licensed under the gnu general public license version 3": "gpl-notice",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "licensed under cc by 4 0": "cc-by-notice",
    "released under the mit license": "mit-notice",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit-text",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd-text",
    "this source code form is subject to the terms of the mozilla public license": "mpl-notice",
    "all rights reserved no part of this publication may be reproduced": "all-rights-reserved",
    "this work is licensed under a creative commons attribution license": "creative-commons",
    "dedicated to the public domain under cc0": "cc0",
}
WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
BREAK = r"[^0-9A-Za-z\x{80}-\x{10FFFF}]+"
#: Share of a template's words that a block must hold.
CONTAINMENT = 0.9


def words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased."""
    return F.filter(F.split(F.translate(text, UPPER, LOWER), BREAK, -1), lambda w: w != "")


def stride(templates: dict[str, str]) -> int:
    """Words of the longest template. A block is twice as long and one begins every so many words, line ends or
    not, so whatever stands in as many consecutive words as a template has lies whole in some block."""
    return max((len(t.split()) for t in templates), default=1)


def block_table(docs: DataFrame, openers: list[str], step: int) -> DataFrame:
    """``(key, block, words)``: the distinct words of every block in which one of the ``openers`` stands."""
    hold = docs.filter(F.col("text").rlike("(?i)" + "|".join(openers))).select("key", words(F.col("text")).alias("w"))
    at = F.filter(F.transform("w", lambda w, i: F.when(w.isin(openers), F.floor(i / step))), lambda b: b.isNotNull())
    near = F.array_distinct(F.flatten(F.transform(at, lambda b: F.array(b - 1, b))))
    each = hold.select("key", "w", F.explode(F.filter(near, lambda b: b >= 0)).alias("block"))
    return each.select("key", "block", F.array_distinct(F.slice("w", (F.col("block") * step + 1).cast("int"), 2 * step)).alias("words"))


def token_order(docs: DataFrame, templates: dict[str, str]) -> dict[str, int]:
    """Rank of every template word by the number of texts of the corpus that hold it, rarest first."""
    known = sorted({w for t in templates for w in t.split()})
    each = docs.select(F.explode(F.array_intersect(words(F.col("text")), F.array(*map(F.lit, known)))).alias("w"))
    count = dict(each.groupBy("w").count().collect())  # at most one row for each template word
    return {w: i for i, w in enumerate(sorted(known, key=lambda w: (count.get(w, 0), w)))}


def template_matches(docs: DataFrame, templates: dict[str, str], containment: float) -> DataFrame:
    """``(key, block, label, part)``: blocks that hold at least ``containment`` of a template's distinct words.

    Words are numbered in the order of their counts, rarest first. A template whose n words must
    match in ``need`` places shares with every matching block one of its first n - need + 1: these are the
    join keys. Before the exact count, lines with too few words go (length), and pairs where the words
    from the shared one on are too few on either side (position).
    """
    spark = docs.sparkSession
    order = token_order(docs, templates)
    entries, openers = [], set()
    for n, (template, label) in enumerate(templates.items()):
        ranks = sorted({order[w] for w in template.split()})
        need = math.ceil(containment * len(ranks) - 1e-9)
        for place, rank in enumerate(ranks[:len(ranks) - need + 1]):
            entries.append((rank, place, n, label, need, ranks))
            openers.add(rank)
    index = spark.createDataFrame(entries, "rank int, place int, template int, label string, need int, ranks array<int>")
    numbers = spark.createDataFrame(list(order.items()), "word string, rank int")
    by_rank = sorted(order, key=order.get)
    blocks = block_table(docs, sorted(by_rank[r] for r in openers), stride(templates))
    ranked = blocks.select("key", "block", F.explode("words").alias("word")).join(numbers, "word").groupBy("key", "block").agg(
        F.array_sort(F.collect_set("rank")).alias("held"))
    pairs = ranked.select("key", "block", "held", F.posexplode("held").alias("at", "rank")).join(index, "rank").filter(
        (F.size("held") >= F.col("need")) & (F.size("held") - F.col("at") >= F.col("need") - F.col("place"))
        & (F.size("ranks") - F.col("place") >= F.col("need") - F.col("at")))
    pairs = pairs.dropDuplicates(["key", "block", "template"])
    part = F.size(F.array_intersect("held", "ranks")) / F.size("ranks")
    return pairs.select("key", "block", "label", part.alias("part")).filter(F.col("part") >= containment - 1e-9)


def phrase_places(text: Column) -> tuple[Column, list[Column]]:
    """The words of a text, and for each phrase the places in a column ``held`` of them where it begins."""
    held = words(text)

    def places(phrase: str) -> Column:
        want = phrase.split()

        def here(w: Column, i: Column) -> Column:
            same = w == want[0]
            for k, x in enumerate(want[1:], 1):
                same = same & F.coalesce(F.get(held_col, i + k) == x, F.lit(False))
            return same
        return F.filter(F.transform(held_col, lambda w, i: F.when(here(w, i), i)), lambda i: i.isNotNull())

    held_col = F.col("held")
    return held, [places(p) for p in PHRASES]


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: dict[str, str] | None = None,
         containment: float = CONTAINMENT) -> DataFrame:
    """``(key, n_words, n_base, first_word, last_word, base_labels, labels, score)`` for every row of ``docs``.

    Base: places where the words of a phrase stand consecutively. The join over blocks (``template_matches``)
    adds labels. ``score`` is the largest containment reached, 1 with a base phrase, else 0. Null texts count
    as empty. Texts are told apart by two hash codes, so rows with a null or repeated key get the labels of
    their own text. Without templates only base labels are given. Other columns are not returned.
    """
    templates = TEMPLATES if templates is None else templates
    plain = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    plain = plain.withColumn("code", F.struct(F.xxhash64("text").alias("x"), F.xxhash64(F.lit(1), "text").alias("y")))
    gate = F.col("text").rlike("(?i)" + "|".join(sorted({p.split()[0] for p in PHRASES})))
    held, places = phrase_places(F.col("text"))
    base = plain.select("key", "code", F.regexp_count("text", F.lit(WORD)).cast("long").alias("n_words"), F.when(gate, held).alias("held"))
    base = base.select("key", "code", "n_words", F.array(*[F.coalesce(p, F.array().cast("array<int>")) for p in places]).alias("at"))
    names = F.array(*[F.when(F.size(F.get("at", n)) > 0, F.lit(label)) for n, label in enumerate(PHRASES.values())])
    base = base.select("key", "code", "n_words", F.flatten("at").alias("at"), F.array_sort(F.filter(names, lambda x: x.isNotNull())).alias("base"))
    if templates:
        found = template_matches(plain.select(F.col("code").alias("key"), "text"), templates, containment).groupBy("key").agg(
            F.collect_set("label").alias("more"), F.max("part").alias("part"))
        both = base.join(found.withColumnRenamed("key", "code"), "code", "left")
    else:
        both = base.select("*", F.lit(None).cast("array<string>").alias("more"), F.lit(None).cast("double").alias("part"))
    every = F.array_sort(F.array_distinct(F.concat("base", F.coalesce("more", F.array().cast("array<string>")))))
    return both.select(
        F.col("key").alias(key), "n_words", F.size("at").cast("long").alias("n_base"), F.array_min("at").cast("long").alias("first_word"),
        F.array_max("at").cast("long").alias("last_word"), F.array_join("base", ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"), F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce("part", F.lit(0.0))).alias("score"))
