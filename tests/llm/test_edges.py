import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from tessel.llm import balltree
from tessel.llm.balltree import exact_topk
from tessel.llm.toxic import FEATURES, ToxicityModel


@pytest.mark.parametrize("labels", [[], [1], [0, 1], [1, 0, 0]])
def test_few_labels(spark, labels):
    texts = ["you idiot", "a fine day", "good morning to all"]
    labelled = spark.createDataFrame([(i, texts[i], y) for i, y in enumerate(labels)], "doc_id long, text string, toxic int")
    model = ToxicityModel.fit(labelled, "doc_id", "text", "toxic")
    docs = spark.createDataFrame([(1, "you idiot", 5, "m"), (2, None, 6, "n"), (3, "", None, None)], "doc_id long, text string, words int, marks string")
    rows = model.score(docs, "text", "score").orderBy("doc_id").collect()
    assert [(r["words"], r["marks"]) for r in rows] == [(5, "m"), (6, "n"), (None, None)]
    assert all(0 <= r["score"] <= 1 for r in rows) and not set(FEATURES) & set(rows[0].asDict())


def test_ids_null_large_and_empty_vectors_over_shards(spark):
    big = 2 ** 62
    rows = [(big + i, [float(i % 7 - 3), float(i % 5)]) for i in range(60)] + [(None, [9.0, 9.0]), (7, []), (8, None), (9, [-1.0])]
    df = spark.createDataFrame(rows, "id long, vec array<double>")
    asked = df.filter(F.col("id").isin(big, big + 3, 7) | F.col("id").isNull())
    got = {}
    for r in exact_topk(df, asked, shard_rows=8, block=2).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    held = [(i, v) for i, v in rows if i is not None and v is not None]
    for q, vec in held:
        if q in (big, big + 3, 7):
            scored = sorted(((-sum(int(a * b) for a, b in zip(vec, v)), i) for i, v in held if i != q))[:5]
            assert sorted(got.pop(q)) == [(n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    assert not got


@pytest.mark.parametrize("copies", [0, 1, 2])
def test_top_k_sends_one_vector_a_record(spark, monkeypatch, copies):
    """Trees and packs of queries are not copied into records for each other, and later rounds use the floors of earlier ones."""
    monkeypatch.setattr(balltree, "COPIES", copies)
    seen, kept = [], DataFrame.mapInArrow
    monkeypatch.setattr(DataFrame, "mapInArrow", lambda self, *rest, **more: seen.append(self.schema) or kept(self, *rest, **more))
    monkeypatch.setattr(DataFrame, "mapInPandas", lambda self, *rest, **more: pytest.fail("records of whole trees"))
    rows = [(i, [float((i * j) % 11 - 5) for j in range(1, 4)]) for i in range(90)] + [(5, [2.0, 2.0, 2.0])] * 3
    df = spark.createDataFrame(rows, "id long, vec array<double>")
    got = {}
    for r in exact_topk(df, df.filter("id % 2 = 1"), k=3, shard_rows=7, block=4).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert len(seen) >= 3 - copies // 2
    assert all(sorted(f.dataType.simpleString() for f in s) == ["array<double>", "bigint", "bigint", "boolean", "double"] for s in seen)
    for q in {i for i, _ in rows if i % 2}:
        pairs = sorted((-int(sum(a * b for a, b in zip(v, w))), i) for v in {tuple(v) for i, v in rows if i == q} for i, w in rows if i != q)[:3]
        assert sorted(got.pop(q)) == [(n + 1, i, -s) for n, (s, i) in enumerate(pairs)]
    assert not got
