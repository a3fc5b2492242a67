import random

import pytest
from pyspark.sql import functions as F

from tessel.llm.replytree import Template, chain_links, format_trees, own_links, read_back

NODES = "tree string, node long, parent long, role string, text string, score double"


def formatted(spark, rows, keep=1, template=Template()):
    nodes = spark.createDataFrame(rows, NODES)
    got = read_back(format_trees(nodes, own_links(nodes, "tree", "node", "parent", "score"), "tree", "node", "role", "text", keep, template), template)
    return {(r["tree"], r["rank"]): r for r in got.collect()}


def brute(rows, keep):
    """Paths by walking up from every leaf."""
    out = {}
    for tree in {r[0] for r in rows}:
        mine = {r[1]: r for r in rows if r[0] == tree}
        leaves = [n for n in mine if n not in {r[2] for r in mine.values()}]
        found = []
        for leaf in leaves:
            path, at = [], leaf
            while at in mine:
                path.append(mine[at])
                at = mine[at][2]
            found.append((-sum(r[5] or 0 for r in path) / len(path), -len(path), f"={leaf}", path[::-1]))
        for rank, (_, _, _, path) in enumerate(sorted(found, key=lambda f: f[:3])[:keep], 1):
            out[(tree, rank)] = [(r[3] or "", r[4] or "") for r in path]
    return out


@pytest.mark.parametrize("hot", [False, True])
def test_paths_equal_brute_force(spark, hot, monkeypatch):
    if hot:
        monkeypatch.setattr("tessel.llm.replytree.HOT_ROWS", 20)
    rng = random.Random(5)
    rows = []
    for t in range(12):
        for n in range(rng.randint(1, 60)):
            parent = None if n == 0 else rng.randrange(max(0, n - rng.choice([1, 8])), n)
            rows.append((f"t{t}", n, parent, rng.choice(["user", "assistant", "system", "tool", None]), rng.choice(["a", "", None, "[INST] x", "</s>"]),
                         rng.choice([None, 0.25, 0.5, 1.0])))
    got = formatted(spark, rows, keep=3)
    want = brute(rows, 3)
    assert {k: [tuple(t) for t in r["turns"]] for k, r in got.items()} == want
    for k, r in got.items():
        assert r["trained"] == "".join(t for role, t in want[k] if role == "assistant")
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]


def test_marks_in_texts_come_back(spark):
    marks = ["[INST]", "[/INST]", "<s>", "</s>", "[~INST]", "<~~/s>", "[ROLE]", "[TEXT]", "[/ROLE]", "[SYSTEM_PROMPT] ", "<", "[", "</s", "[/INST", " ", "~", "\\", "$1", "\n"]
    rng = random.Random(1)
    rows = [(f"c{i}", n, n - 1 if n else None, rng.choice(["user", "assistant", "system", "[TEXT]x", "</s>", "", "a\nb"]),
             "".join(rng.choices(marks, k=rng.randint(0, 7))), None) for i in range(60) for n in range(4)]
    got = formatted(spark, rows)
    for i in range(60):
        mine = [(r[3], r[4]) for r in rows if r[0] == f"c{i}"]
        assert [tuple(t) for t in got[(f"c{i}", 1)]["turns"]] == mine
        assert got[(f"c{i}", 1)]["formatted"].count("[INST] ") == sum(r == "user" for r, _ in mine)


def test_long_chain_cycles_repeats_and_nulls(spark):
    chain = [("long", n, n - 1 if n else None, "user", f"w{n}", None) for n in range(3000)]
    cycle = [("ring", 0, 2, "user", "a", None), ("ring", 1, 0, "user", "b", None), ("ring", 2, 1, "user", "c", None), ("ring", 3, 2, "user", "d", None)]
    orphan = [("orphan", 5, 99, "user", "top", None), ("orphan", 6, 5, "assistant", "end", None)]
    same = [("same", 0, None, "user", "b", None), ("same", 0, None, "user", "a", None), ("same", 1, 0, "assistant", "c", None)]
    null = [(None, None, None, "user", "x", None)]
    got = formatted(spark, chain + cycle + orphan + same + null, keep=9)
    assert [t["text"] for t in got[("long", 1)]["turns"]] == [f"w{n}" for n in range(3000)]
    assert not any(t == "ring" for t, _ in got)
    assert [t["text"] for t in got[("orphan", 1)]["turns"]] == ["top", "end"]
    assert [t["text"] for t in got[("same", 1)]["turns"]] == ["a", "b", "c"]
    assert [t["text"] for t in got[(None, 1)]["turns"]] == ["x"]


def test_conversations_without_rows_and_with_clashing_columns(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert format_trees(empty, chain_links(empty, "conv_id", "turn"), "conv_id", "turn", "role", "text").count() == 0
    rows = spark.createDataFrame([(1, 1, "user", "q"), (1, None, "system", "s"), (1, 2, "assistant", "a"), (None, 0, None, None)],
                                 "conv_id long, turn long, role string, text string").withColumn("leaf", F.lit(1)).withColumn("rank", F.lit(2)).withColumn("node", F.lit(3))
    got = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in
           read_back(format_trees(rows, chain_links(rows, "conv_id", "turn"), "conv_id", "turn", "role", "text")).collect()}
    assert got == {1: [("system", "s"), ("user", "q"), ("assistant", "a")], None: [("", "")]}
