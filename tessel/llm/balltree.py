"""Exact inner-product top k by ball-tree branch and bound in shards."""

from __future__ import annotations

import gc

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tessel.llm.scratch import Scratch

LEAF = 256
#: Queries sent to shards in a round, for each vector: the records of a round grow with the vectors, not with their square.
COPIES = 2
NONE = np.iinfo(np.int64).max


def grow(x: np.ndarray, ids: np.ndarray, leaf: int = LEAF) -> dict[str, np.ndarray]:
    """Ball tree over the rows of ``x``: halves along the line between two far points.

    Node i covers rows ``lo[i]:hi[i]`` within ``radius[i]`` of ``center[i]``; ``kid[i]`` is its first
    child (the other one follows), or 0. Equal points are not split.
    """
    order = np.arange(len(x))
    lo, hi, kid, center, radius = [0], [len(x)], [0], [], []
    i = 0
    while i < len(lo):
        rows = x[order[lo[i]:hi[i]]]
        mid = rows.mean(0)
        gap = np.sqrt(((rows - mid) ** 2).sum(1))
        center.append(mid)
        radius.append(gap.max())
        if len(rows) > leaf and gap.max() > 0:
            a = rows[gap.argmax()]
            b = rows[((rows - a) ** 2).sum(1).argmax()]
            half = len(rows) // 2
            order[lo[i]:hi[i]] = order[lo[i]:hi[i]][np.argpartition(rows @ (b - a), half)]
            kid[i] = len(lo)
            lo += [lo[i], lo[i] + half]
            hi += [lo[i] + half, hi[i]]
            kid += [0, 0]
        i += 1
    return {"x": x[order], "ids": ids[order], "lo": np.array(lo), "hi": np.array(hi), "kid": np.array(kid),
            "center": np.array(center), "radius": np.array(radius)}


def search(tree: dict, q: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """``(score, id)`` of the best ``k`` rows for each query, ties to the smaller id.

    ``floor`` is a score already reached k times elsewhere; nodes whose bound lies below it, or below
    the kth score found so far, are skipped. Rows with the query's own id take no part.
    """
    score, found = np.full((len(q), k), -np.inf), np.full((len(q), k), NONE)
    norm = np.sqrt((q ** 2).sum(1))

    def bound(node: int, who: np.ndarray) -> np.ndarray:
        return (q[who] @ tree["center"][node] + norm[who] * tree["radius"][node]) * (1 + 1e-12) + 1e-3

    def visit(node: int, who: np.ndarray) -> None:
        who = who[bound(node, who) >= np.maximum(floor[who], score[who, -1])]
        if not len(who):
            return
        kid = tree["kid"][node]
        if kid:
            first = bound(kid, who) >= bound(kid + 1, who)
            for child, part in ((kid, who[first]), (kid + 1, who[first]), (kid + 1, who[~first]), (kid, who[~first])):
                visit(child, part)
            return
        ids = tree["ids"][tree["lo"][node]:tree["hi"][node]]
        got = q[who] @ tree["x"][tree["lo"][node]:tree["hi"][node]].T
        got[ids[None, :] == own[who][:, None]] = -np.inf
        all_score = np.hstack([score[who], got])
        all_id = np.hstack([found[who], np.broadcast_to(ids, got.shape)])
        all_id = np.where(np.isneginf(all_score), NONE, all_id)
        best = np.lexsort((all_id, -all_score), axis=1)[:, :k]
        score[who], found[who] = np.take_along_axis(all_score, best, 1), np.take_along_axis(all_id, best, 1)

    visit(0, np.arange(len(q)))
    return score, found


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of numbers as rows, shorter ones padded with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), int(lengths.max(initial=0))))
    row = np.repeat(np.arange(len(column)), lengths)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = column.flatten().to_numpy()
    return out


def _wide(x: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``width`` numbers, cut or padded with zeros."""
    return np.pad(x[:, :width], ((0, 0), (0, max(0, width - x.shape[1]))))


def _searcher(k: int, block: int):
    """Searches record by record: the vectors of a shard come first and become its tree, then its queries."""
    def run(batches):
        held, parts, tree = None, [], None
        for batch in batches:
            shard, query = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((np.diff(shard) != 0) | (np.diff(query.astype(int)) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(shard)]):
                if shard[a] != held:
                    held, parts, tree = shard[a], [], None
                if not query[a]:
                    parts.append((batch.column(2).slice(a, b - a).to_numpy(), _matrix(batch.column(3).slice(a, b - a))))
                    continue
                if parts:
                    width = max(x.shape[1] for _, x in parts)
                    tree, parts = grow(np.concatenate([_wide(x, width) for _, x in parts]), np.concatenate([i for i, _ in parts])), []
                if tree is None:
                    continue
                for c in range(a, b, block):
                    n = min(block, b - c)
                    ids, q = batch.column(2).slice(c, n).to_numpy(), _wide(_matrix(batch.column(3).slice(c, n)), tree["x"].shape[1])
                    floor = np.nan_to_num(batch.column(4).slice(c, n).to_numpy(zero_copy_only=False).astype(np.float64), nan=-np.inf, neginf=-np.inf)
                    score, found = search(tree, q, ids, floor, k)
                    at = np.nonzero((found != NONE) & (score >= floor[:, None]))
                    yield pa.RecordBatch.from_arrays([pa.array(ids[at[0]]), pa.array(found[at]), pa.array(score[at].astype(np.int64))],
                                                     names=["query_id", "vec_id", "score"])
    return run


def exact_topk(vectors: DataFrame, queries: DataFrame, k: int = 5, shard_rows: int = 8192, block: int = 512) -> DataFrame:
    """Best ``k`` rows of ``vectors (id, vec)`` for each of ``queries (id, vec)`` by integer inner product.

    Returns query_id, rank (from 1), vec_id, score; ties go to the smaller id, a query's own id takes no
    part, fewer rows give fewer ranks, repeated query rows count once. A shorter vector counts as padded
    with zeros; null and empty vectors and rows without an id take no part. Rows are dealt to shards of about
    ``shard_rows``; the task that searches a shard makes a ball tree of it and takes its queries ``block`` by
    block, so no record holds more than one vector. Every query searches one shard first; then it goes round the
    others, several a round, and its kth score so far is the floor in the next round.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "balls")

    def whole(df: DataFrame) -> DataFrame:
        return df.filter("id is not null and size(vec) > 0").select(F.col("id").cast("long").alias("id"), F.col("vec").cast("array<double>").alias("vec"))

    # rows that repeat an id and a vector go to different shards too
    rows = scratch.put(whole(vectors).withColumn("pick", F.xxhash64("id", F.monotonically_increasing_id())))
    asked = scratch.put(whole(queries).distinct())
    n_rows, n_asked = rows.count(), asked.count()
    shards = max(1, -(-n_rows // shard_rows))
    dealt = rows.select(F.expr(f"pmod(pick, {shards})").alias("shard"), F.lit(False).alias("query"), "id", "vec", F.lit(None).cast("double").alias("floor"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    best, start = None, 0
    while start < shards:
        stop = 1 if start == 0 else min(shards, start + max(1, COPIES * n_rows // max(n_asked, 1)))
        who = asked.withColumn("floor", F.lit(None).cast("double"))
        if best is not None:
            floors = best.groupBy("query_id").agg(F.min("score").alias("m"), F.count("*").alias("n")).select(
                F.col("query_id").alias("id"), F.expr(f"if(n >= {k}, cast(m as double), null)").alias("floor"))
            who = asked.join(floors, "id", "left")
        home = F.expr(f"pmod(xxhash64(id), {shards})")
        sent = who.withColumn("turn", F.explode(F.sequence(F.lit(start), F.lit(stop - 1)))).select(
            ((home + F.col("turn")) % shards).alias("shard"), F.lit(True).alias("query"), "id", "vec", "floor")
        found = dealt.unionAll(sent).repartition(min(shards, 4096), "shard").sortWithinPartitions("shard", "query").mapInArrow(
            _searcher(k, block), "query_id long, vec_id long, score long")
        found = found if best is None else best.select("query_id", "vec_id", "score").unionAll(found)
        last, best = best, scratch.put(found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
        scratch.drop(last)
        if stop < shards:  # the plans of a round are garbage now; collecting them lets Spark delete their shuffle files
            found = who = sent = last = None
            gc.collect()
            spark._jvm.System.gc()
        start = stop
    scratch.only(best)
    return best
