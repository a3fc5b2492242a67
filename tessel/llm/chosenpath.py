"""Set-similarity join by chosen paths: near-duplicate documents and their connected classes."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessel.llm.graph import components
from tessel.llm.scratch import Scratch, keep_keys
from tessel.llm.text import chunks, mix, shingles

#: Nodes up to this size are compared exhaustively.
LEAF = 1024
#: ... or up to this many tokens, which bounds a group's memory.
LEAF_TOKENS = 2_000_000
#: Branches of a set below a node.
WAYS = 2
#: Chance that a pair right at the threshold shares no leaf, over all trees.
MISS = 1e-6
#: Mixed nodes of up to this many blocks do not branch: their blocks meet in pairs.
PAIRED = 8
#: Levels of branching; below them all blocks of a mixed node meet in pairs.
LEVELS = 8
_SEEDS = np.random.default_rng(4711).integers(1, 2**62, (LEVELS + 1, 64)).astype(np.uint64)


def _sets(codes: np.ndarray, off: np.ndarray):
    for a, b in zip(off, off[1:]):
        yield np.unique(codes[a:b])


def _lowest(codes: np.ndarray, off: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """For each text and seed, the smallest mixed code: the token that a path chooses there."""
    out = np.zeros((len(off) - 1, len(seeds)), np.uint64)
    full = np.flatnonzero(np.diff(off))
    if len(full):
        for j, seed in enumerate(seeds):
            out[full, j] = np.minimum.reduceat(mix(codes ^ seed), off[:-1][full])
    return out.view(np.int64)


def _sketch(k: int, trees: int):
    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for row, words in chunks(batch.column(1)):
                codes, off = shingles(words, k)
                size, one, two = [], [], []
                for s in _sets(codes, off):
                    size.append(len(s))
                    one.append(int(s.sum(dtype=np.uint64)))
                    two.append(int(mix(s ^ _SEEDS[-1, 0]).sum(dtype=np.uint64)))
                low = _lowest(codes, off, _SEEDS[0, :trees])
                yield pa.RecordBatch.from_pydict({
                    "id": ids.slice(row, len(size)), "n": pa.array(size, pa.int64()),
                    "f1": np.array(one, np.uint64).view(np.int64), "f2": np.array(two, np.uint64).view(np.int64),
                    "keys": pa.ListArray.from_arrays(pa.array(np.arange(len(size) + 1) * trees, pa.int32()), low.ravel())})
    return run


def _full_sets(k: int):
    def run(batches):
        for batch in batches:
            for row, words in chunks(batch.column(1)):
                sets = [s.tobytes() for s in _sets(*shingles(words, k))]
                yield pa.RecordBatch.from_pydict({"rep": batch.column(0).slice(row, len(sets)), "tokens": pa.array(sets, pa.large_binary())})
    return run


def _branch(level: int, k: int):
    """``(node, rep, keys)``: where the set of ``(id, t, nodes)`` goes below each of its nodes.

    Every node has hashes of its own, so the paths of a pair in different nodes and trees are independent.
    """
    def run(batches):
        for batch in batches:
            held = batch.column(2)
            all_nodes, at = held.values.to_numpy().view(np.uint64), held.offsets.to_numpy()
            for row, words in chunks(batch.column(1)):
                codes, off = shingles(words, k)
                n = len(off) - 1
                nodes, mine = [], []
                for d in range(n):
                    own, here = codes[off[d]:off[d + 1]], all_nodes[at[row + d]:at[row + d + 1]] if off[d] < off[d + 1] else all_nodes[:0]
                    low = np.zeros((len(here), WAYS), np.uint64)
                    strip = max(1, (1 << 18) // max(1, len(own)))
                    for way in range(WAYS):
                        seeds = mix(here ^ _SEEDS[level, way])
                        for i in range(0, len(here), strip):
                            low[i:i + strip, way] = mix(own[None, :] ^ seeds[i:i + strip, None]).min(1)
                    nodes.append(here)
                    mine.append(low)
                count = np.array([len(x) for x in nodes])
                yield pa.RecordBatch.from_pydict({
                    "node": np.concatenate(nodes).view(np.int64), "rep": batch.column(0).slice(row, n).take(pa.array(np.repeat(np.arange(n), count))),
                    "keys": pa.ListArray.from_arrays(pa.array(np.arange(count.sum() + 1) * WAYS, pa.int32()), np.concatenate(mine).view(np.int64).ravel())})
    return run


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of token indicators in strips."""
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    tokens, at, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times > 1
    place = np.cumsum(shared) - 1
    use = shared[at]
    order = np.argsort(place[at[use]], kind="stable")
    column, row = place[at[use]][order], owner[use][order]
    both = np.zeros((len(sets), len(sets)), np.float32)
    strip = max(256, min(4096, (1 << 21) // len(sets)))
    for low in range(0, int(shared.sum()), strip):
        a, b = np.searchsorted(column, [low, low + strip])
        m = np.zeros((len(sets), strip), np.float32)
        m[row[a:b], column[a:b] - low] = 1
        both += m @ m.T
    return both.astype(np.int64)


def _whole_groups(batches):
    """Tables of whole groups from batches sorted by their first column, and the bounds of the groups."""
    rest = None
    for batch in batches:
        if batch.num_rows:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            g = table.column(0).to_numpy()
            at = int(np.searchsorted(g, g[-1]))
            if at:
                yield table.slice(0, at).combine_chunks(), _bounds(g[:at])
            rest = table.slice(at)
    if rest is not None:
        yield rest.combine_chunks(), _bounds(rest.column(0).to_numpy())


def _bounds(g: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1], [True]]))


def _heads(rep: np.ndarray, sets: list[np.ndarray], percent: int) -> np.ndarray:
    """For each set of a group, the first of its class; all pairs of the group are compared."""
    size = np.array([len(s) for s in sets])
    if len(sets) == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return rep[[0, 0]] if 100 * both >= percent * (size.sum() - both) else rep
    both = overlaps(sets)
    i, j = np.nonzero(np.triu(100 * both >= percent * (size[:, None] + size[None, :] - both), 1))
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for x, y in zip(i.tolist(), j.tolist()):
        u, v = find(x), find(y)
        if u != v:
            root[max(u, v)] = min(u, v)
    return rep[[find(x) for x in range(len(sets))]]


def _compare(percent: int):
    """``(a, b)``: each set of a group ``(g, rep, tokens)`` and the first set of its class."""
    def run(batches):
        for table, bounds in _whole_groups(batches):
            rep, tokens = table.column("rep").to_numpy(), table.column("tokens")
            a, b = [], []
            for low, high in zip(bounds, bounds[1:]):
                rows = sorted({(int(rep[i]), tokens[int(i)].as_py()) for i in range(low, high)})
                if len(rows) > 1:
                    ids = np.array([r for r, _ in rows])
                    a.append(ids)
                    b.append(_heads(ids, [np.frombuffer(raw, np.uint64) for _, raw in rows], percent))
            if a:
                a, b = np.concatenate(a), np.concatenate(b)
                yield pa.RecordBatch.from_pydict({"a": a[a != b], "b": b[a != b]})
    return run


def _near(n: np.ndarray, keys: np.ndarray, other: np.ndarray, others: np.ndarray, percent: int, least: int) -> np.ndarray:
    """Whether sets of ``n`` and ``other`` tokens fit in size and start on enough equal tokens."""
    same = sum((keys[..., t] == others[..., t]).astype(np.int8) for t in range(keys.shape[-1]))
    return (same >= least) & (100 * np.minimum(n, other) >= percent * np.maximum(n, other))


def _agreeing(percent: int, least: int):
    """Parts ``reps`` of the groups ``(g, rep, n, keys)`` that hold every pair with enough equal tokens and fitting sizes."""
    def run(batches):
        for table, bounds in _whole_groups(batches):
            rep, n = table.column("rep").to_numpy(), table.column("n").to_numpy()
            keys = table.column("keys").combine_chunks().flatten().to_numpy().reshape(len(n), -1)
            size = np.diff(bounds)
            two = bounds[:-1][size == 2]  # most groups: all at once
            two = two[_near(n[two], keys[two], n[two + 1], keys[two + 1], percent, least) & (rep[two] != rep[two + 1])]
            parts = [np.sort(np.stack([rep[two], rep[two + 1]], 1), 1).ravel()]
            sizes = [2] * len(two)
            for low, high in zip(bounds[:-1][size > 2], bounds[1:][size > 2]):
                m, k = n[low:high], keys[low:high]
                near = _near(m[:, None], k[:, None], m[None, :], k[None, :], percent, least)
                part = np.arange(high - low)
                while True:
                    lowest = np.where(near, part[None, :], high - low).min(1)
                    if (lowest >= part).all():
                        break
                    part = np.minimum(part, lowest)
                order = np.argsort(part, kind="stable")
                for rows in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
                    ids = np.unique(rep[low:high][rows]) if len(rows) > 1 else rows
                    if len(ids) > 1:
                        parts.append(ids)
                        sizes.append(len(ids))
            yield pa.RecordBatch.from_pydict({"reps": pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(np.concatenate(parts), pa.int64()))})
    return run


def _trees(percent: int) -> tuple[int, int]:
    """Trees to grow, and in how many of them a pair must start on the same token to be compared.

    A pair at the threshold survives the levels of a tree with the odds of a branching process; it
    misses all trees, or starts together in too few, with odds under MISS each.
    """
    p = min(percent, 99) / 100
    survive = 1.0
    for _ in range(LEVELS):
        survive = 1 - (1 - p * survive) ** WAYS
    trees = max(4, math.ceil(math.log(MISS) / math.log(1 - p * survive)) + 3)
    below, least = (1 - p) ** trees, 0
    while below <= MISS:
        least += 1
        below += math.comb(trees, least) * p ** least * (1 - p) ** (trees - least)
    return trees, max(1, least)


def _sorted(rows: DataFrame) -> DataFrame:
    """Rows of a group ``g`` one after another in one partition, so that a task reads many groups a batch."""
    return rows.repartition("g").sortWithinPartitions("g")


def _linked(groups: DataFrame, reps: DataFrame, held: list, plain: DataFrame, k: int, percent: int, least: int, scratch: Scratch,
            edges: DataFrame | None) -> DataFrame:
    """Adds the links found in ``groups (g, rep)``: first on start tokens and sizes, then on full sets.

    ``held`` collects tables of full sets; only sets that none of them has are made.
    """
    parts = _sorted(groups.join(reps, "rep").select("g", "rep", "n", "keys")).mapInArrow(_agreeing(percent, least), "reps array<long>")
    parts = scratch.put(parts.distinct().select(F.xxhash64("reps").alias("g"), F.explode("reps").alias("rep")))
    wanted = parts.select(F.col("rep").alias("id")).distinct()
    for sets in held:
        wanted = wanted.join(sets.select(F.col("rep").alias("id")), "id", "left_anti")
    wanted = scratch.put(wanted)
    if not wanted.isEmpty():
        held.append(scratch.put(keep_keys(plain, wanted, ["id"]).mapInArrow(_full_sets(k), "rep long, tokens binary")))
    if not held:
        return edges if edges is not None else scratch.put(groups.sparkSession.createDataFrame([], "a long, b long"))
    sets = reduce(DataFrame.unionAll, held)
    found = scratch.put(_sorted(parts.join(sets, "rep").select("g", "rep", "tokens")).mapInArrow(_compare(percent), "a long, b long"))
    scratch.drop(parts, wanted)
    return found if edges is None else edges.unionAll(found)


def similar_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 85, k: int = 5) -> DataFrame:
    """``(key, n_shingles, component_id, kept)``: classes of documents linked by Jaccard of word shingles.

    Texts with 100 * intersection >= percent * union of their sets are linked, confirmed on full sets; a
    class is everything reachable, named by its smallest key, which alone is kept. Null and wordless texts
    have empty sets and link with nothing. Rows that repeat a key share its class. A null key is returned
    with itself (null) as its class and kept.

    Equal sets become one representative. A representative's path in tree t starts at its smallest token
    under the tree's hash. Nodes of up to LEAF sets are compared exhaustively. A larger node is compared in
    blocks that all hold its first set. If that leaves it in one class, it is done; if the sets outside its
    largest class fill half a leaf at most, they are compared with every block of that class; else the blocks of a
    node of up to PAIRED of them meet in pairs, so that a group of near copies ends at once; a larger node
    branches, each set to two further nodes by hashes of that node alone, and so on. With two branches a pair
    at the threshold survives any number of levels with odds near 0.97 a tree; there are as many trees as keep the
    chance to miss it under MISS.
    """
    scratch = Scratch(docs.sparkSession, "paths")
    trees, least = _trees(percent)
    plain = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("t"))
    schema = "id long, n long, f1 long, f2 long, keys array<long>"
    all_rows = scratch.put(plain.mapInArrow(_sketch(k, trees), schema))
    rows = all_rows.filter("n > 0 and id is not null")
    same = rows.groupBy("f1", "f2", "n").agg(F.min("id").alias("rep"))
    member = scratch.put(rows.select("id", "f1", "f2", "n").join(same, ["f1", "f2", "n"]).select("id", "rep"))
    reps = same.select(F.col("rep").alias("id"), "rep", "f1", "f2", "n").join(rows, ["id", "f1", "f2", "n"]).select("rep", "n", "keys").distinct()
    starts, edges, held_sets = scratch.put(reps), None, []
    nodes = scratch.put(starts.select("rep", "n", F.posexplode("keys").alias("tree", "token")).select(
        F.xxhash64("tree", "token").alias("node"), "rep", "n").distinct())
    for level in range(1, LEVELS + 2):
        sizes = scratch.put(nodes.groupBy("node").agg(
            F.count("*").alias("size"), F.greatest(F.count("*") / LEAF, F.sum("n") / LEAF_TOKENS).alias("fill"),
            F.min("rep").alias("lead")).filter("size > 1"))
        met = scratch.put(nodes.join(sizes, "node"))
        scratch.drop(nodes, sizes)
        if met.isEmpty():
            break
        small = met.filter("fill <= 1 or size = 2").groupBy("node").agg(F.sort_array(F.collect_list("rep")).alias("reps"))
        small = small.select("reps").distinct().select(F.xxhash64("reps").alias("g"), F.explode("reps").alias("rep"))
        large = met.filter("fill > 1 and size > 2").withColumn("blocks", F.expr("cast(pow(2, ceil(log2(fill))) as long)"))
        large = large.withColumn("block", F.expr("pmod(xxhash64(rep), blocks)"))
        part = large.select("lead", "blocks", "block", "rep").distinct()
        part = part.unionAll(part.select("lead", "blocks", "block", F.col("lead").alias("rep")).distinct())
        part = part.select(F.xxhash64("lead", "blocks", "block").alias("g"), "rep")
        groups = scratch.put(small.unionAll(part).distinct())
        edges = _linked(groups, starts, held_sets, plain, k, percent, least, scratch, edges)
        scratch.drop(groups)
        if large.isEmpty():
            break
        labels = components(edges, scratch)
        held = scratch.put(large.select("node", "rep", "n", "blocks", "block").join(
            labels.withColumnRenamed("id", "rep"), "rep", "left").withColumn("label", F.coalesce("component", "rep")).drop("component"))
        scratch.drop(labels, met)
        tally = held.groupBy("node", "label").agg(F.count("*").alias("c"))
        tally = tally.groupBy("node").agg(F.sum("c").alias("all"), F.max("c").alias("most"), F.max_by("label", "c").alias("main"))
        mixed = scratch.put(held.join(tally.filter("all > most"), "node"))
        scratch.drop(held)
        ends = F.col("all") - F.col("most") <= LEAF // 2
        few = mixed.filter(ends)
        inside = few.filter("label = main").select("node", "blocks", "block", "rep")
        outside = few.filter("label <> main").select("node", "blocks", F.explode(F.expr("sequence(0L, blocks - 1)")).alias("block"), "rep")
        last = inside.unionAll(outside).select(F.xxhash64("node", "blocks", "block", F.lit("end")).alias("g"), "rep")
        # every two blocks meet once
        wide = F.lit(False) if level > LEVELS else F.col("blocks") > PAIRED
        pairs = mixed.filter(~ends & ~wide).withColumn("other", F.explode(F.expr("filter(sequence(0L, blocks - 1), x -> x <> block)")))
        last = last.unionAll(pairs.select(F.xxhash64("node", F.least("block", "other"), F.greatest("block", "other")).alias("g"), "rep"))
        edges = _linked(scratch.put(last), starts, held_sets, plain, k, percent, least, scratch, edges)
        again = mixed.filter(~ends & wide)
        if again.isEmpty():
            break
        where = scratch.put(again.groupBy(F.col("rep").alias("id")).agg(F.collect_set("node").alias("nodes")))
        turn = scratch.put(keep_keys(plain, where.select("id"), ["id"]).join(where, "id").select("id", "t", "nodes").mapInArrow(
            _branch(level, k), "node long, rep long, keys array<long>"))
        nodes = scratch.put(again.select("node", "rep", "n").join(turn, ["node", "rep"]).select(
            "node", "rep", "n", F.posexplode("keys").alias("way", "token")).select(
            F.xxhash64("node", "way", "token").alias("node"), "rep", "n").distinct())
        scratch.drop(mixed, where, turn)
    scratch.drop(*held_sets)
    named = member.select("id", "rep").distinct()
    if edges is not None:
        labels = components(edges, scratch)
        named = named.join(labels.withColumnRenamed("id", "rep"), "rep", "left").withColumn("rep", F.coalesce("component", "rep"))
    chains = named.groupBy("id").agg(F.min("rep").alias("rep"), F.count("*").alias("sets"))
    if not chains.filter("sets > 1").isEmpty():  # a key with several texts ties their classes together
        tied = components(named.select(F.col("id").alias("a"), F.col("rep").alias("b")), scratch)
        chains = chains.select("id").join(tied, "id", "left").select("id", F.coalesce("component", "id").alias("rep"))
    out = all_rows.select("id", F.col("n").alias("n_shingles")).join(chains.select("id", "rep"), "id", "left")
    whole = F.coalesce("rep", "id")
    return out.select(F.col("id").alias(key), "n_shingles", whole.alias("component_id"),
                      F.coalesce(whole == F.col("id"), F.lit(True)).alias("kept"))
