import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessel.llm import phrases


def brute(rows, least, top):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    count, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(lower)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            n[lang] += len(words)
            for m in range(1, 6):
                for i in range(len(words) - m + 1):
                    key = lang, tuple(words[i:i + m])
                    count[key] = count.get(key, 0) + 1
    found = {k: a for k, a in count.items() if a >= least}
    out = []
    for (lang, p), a in found.items():
        m = len(p)
        if m < 2 or any(l == lang and len(q) > m and b >= a and any(q[i:i + m] == p for i in range(len(q) - m + 1)) for (l, q), b in found.items()):
            continue
        cuts = [(1000 * a * n[lang] // (count[lang, p[:k]] * count[lang, p[k:]]), k) for k in range(1, m)]
        score, k = min(cuts)
        out.append((lang, -score, -a, " ".join(p).encode(), count[lang, p[:k]], count[lang, p[k:]], n[lang]))
    out.sort()
    ranked, seen = [], Counter()
    for lang, score, a, p, l, r, total in out:
        seen[lang] += 1
        if seen[lang] <= top:
            ranked.append((lang, seen[lang], p.decode(), -a, l, r, total, -score))
    return ranked


def texts(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["É", "Éa", "AB", "ab", "x y", "-"]
    common = "to be or not to be that is"
    rows = []
    for i in range(n):
        said = [rng.choice(words) if rng.random() < 0.8 else common for _ in range(rng.randint(0, 30))]
        rows.append((rng.choice(["en", "en", "fr", None, "und"]), "".join(w + rng.choice([" ", " ", "  ", "\t", ". ", "\n", ",", "\r"]) for w in said)))
    return rows + [("en", None), ("en", ""), (None, None), ("fr", "..."), ("en", "a " * 500)]


@pytest.mark.parametrize("group", [2_000_000, 40])
def test_equal_to_brute_force(spark, group, monkeypatch):
    monkeypatch.setattr(phrases, "GROUP", group)  # small groups lengthen prefixes
    rows = texts(3, 150)
    docs = spark.createDataFrame(rows, "lang string, text string").withColumn("key", F.lit(1)).withColumn("n", F.lit(2)).withColumn("k1", F.lit("x"))
    got = [tuple(r) for r in phrases.collocations(docs.repartition(3), least=6, top=60).collect()]
    assert sorted(got) == sorted(brute(rows, 6, 60))


def test_trees_across_batches_and_tasks(spark, monkeypatch):
    monkeypatch.setattr(phrases, "HELD", 5)
    rows = texts(4, 60)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(2)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = [tuple(r) for r in phrases.collocations(docs, least=4, top=1000).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(got) == sorted(brute(rows, 4, 1000))


def test_empty_and_phraseless(spark):
    none = spark.createDataFrame([], "lang string, text string")
    assert phrases.collocations(none).count() == 0
    assert phrases.collocations(spark.createDataFrame([("en", "one two"), (None, None)], "lang string, text string")).count() == 0


def test_products_beyond_64_bits(spark):
    """The score's expression alone, at counts no small table reaches."""
    row = spark.range(1).selectExpr("cast(900000000007 as long) a", "cast(90000000000011 as long) n", "cast(900000000008 as long) l", "cast(900000000009 as long) r")
    got = row.selectExpr("(cast(1000 as decimal(5,0)) * cast(a as decimal(15,0)) * cast(n as decimal(17,0))) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0))) s").first()[0]
    assert got == 1000 * 900000000007 * 90000000000011 // (900000000008 * 900000000009)


def test_words_held_are_bounded(monkeypatch):
    """A small vocabulary in a long table: what a task holds does not grow with the rows."""
    monkeypatch.setattr(phrases, "HELD", 10)
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * 50, "text": ["a b c " * 200_000] + ["a b c"] * 49})
    parts = list(phrases._words([batch] * 40))
    assert len(parts) > 1
    assert sum(sum(p.column("n").to_pylist()) for p in parts) == 40 * 3 * (200_000 + 49)
