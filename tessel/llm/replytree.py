"""Reply trees: every root-to-leaf path, the best branches of each tree, one formatted conversation a branch.

Built-in functions only. Paths are found on narrow rows (tree, node, parent): jump tables to the ancestor
2**k replies up, each joined from the one before, then every leaf takes the jumps from the longest to the
shortest, which reaches each of its ancestors exactly once. So a chain of a million replies takes twenty
joins. Texts are shuffled once, by tree; trees above a share of all rows are spread by node first.

Defined results: null roles and texts are empty; a null tree is a tree of its own and a null node a node of
its own; a parent that is missing or absent makes a root; rows that repeat a node are turns at one place of
the path, ordered by role and text; nodes on a cycle, or below one, have no root and no path. Columns beside
the named ones are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tessel.llm.scratch import Scratch

#: A tree with this many rows, and this share of all, is spread over tasks by node; so at most 1 / share are.
HOT_ROWS, HOT_SHARE = 100_000, 1e-4


@dataclass(frozen=True)
class Template:
    """How turns are marked: ``(before, after)`` by role; other roles go between ``other`` marks by name.

    The text of ``trained`` roles is under the loss mask. Every mark is a control string, perhaps with a
    blank at its inner side. A control string begins with an opening bracket and has none further in, so
    none can arise across the end of a text. In texts ``stuffing`` goes after the opening bracket of each
    control string and of each one that is stuffed already; taking one out again restores the text.
    """

    begin: str = "<s>"
    turns: tuple = (("user", "[INST] ", " [/INST]"), ("system", "[SYSTEM_PROMPT] ", " [/SYSTEM_PROMPT]"),
                    ("assistant", " ", "</s>"))
    other: tuple = ("[ROLE]", "[TEXT]", "[/ROLE]")
    trained: tuple = ("assistant",)
    stuffing: str = "~"

    def controls(self) -> list[str]:
        marks = [self.begin, *self.other, *(m.strip() for _, *pair in self.turns for m in pair)]
        return sorted({m for m in marks if m})

    def _pattern(self, stuffed: str) -> str:
        heads = "".join(sorted({"\\" + m[0] for m in self.controls()}))
        tails = "|".join(_literal(m[1:]) for m in self.controls())
        return f"([{heads}]){stuffed}({_literal(self.stuffing)}*)({tails})"

    def _where(self, text: Column, replaced: Column) -> Column:
        """Most texts hold no opening bracket and need no pattern."""
        found = F.lit(False)
        for head in sorted({m[0] for m in self.controls()}):
            found = found | text.contains(head)
        return F.when(found, replaced).otherwise(text)

    def escape(self, text: Column) -> Column:
        return self._where(text, F.regexp_replace(text, self._pattern(""), "$1" + self.stuffing.replace("\\", r"\\") + "$2$3"))

    def unescape(self, text: Column) -> Column:
        return self._where(text, F.regexp_replace(text, self._pattern(_literal(self.stuffing)), "$1$2$3"))

    def segments(self, role: Column, text: Column) -> Column:
        """One turn as pieces of output, each with whether it counts for the loss."""
        def piece(text, loss):
            return F.struct(text.alias("text"), F.lit(loss).alias("loss"))

        body = self.escape(text)
        out = F.array(piece(F.concat(F.lit(self.other[0]), self.escape(role), F.lit(self.other[1]), body, F.lit(self.other[2])), False))
        for name, before, after in self.turns:
            made = (F.array(piece(F.lit(before), False), piece(body, True), piece(F.lit(after), False)) if name in self.trained
                    else F.array(piece(F.concat(F.lit(before), body, F.lit(after)), False)))
            out = F.when(role == name, made).otherwise(out)
        return out

    def parse(self, formatted: Column) -> Column:
        """Turns ``(role, text)`` read back from a formatted conversation."""
        closing = [m.strip() for m in (*(a for _, _, a in self.turns), self.other[2])]
        ends = "|".join(map(_literal, closing))
        last = "".join(sorted({_literal(m[-1]) for m in closing}))
        body = F.substr(formatted, F.lit(len(self.begin) + 1))
        pieces = F.filter(F.split(body, f"(?<=[{last}])(?<={ends})"), lambda p: p != "")

        def turn(p):
            def inner(before, after):
                return self.unescape(F.substr(p, F.lit(len(before) + 1), F.length(p) - len(before) - len(after)))

            def both(role, text):
                return F.struct(role.alias("role"), text.alias("text"))

            # a mark that is only a blank says nothing, so turns with such a mark are told by their ending
            marked = sorted(self.turns, key=lambda t: not t[1].strip())
            plain = self.other[0]
            named = F.substring_index(F.substr(p, F.lit(len(plain) + 1), F.length(p) - len(plain) - len(self.other[2])), self.other[1], 1)
            rest = F.substr(p, F.length(named) + len(plain) + len(self.other[1]) + 1,
                            F.length(p) - F.length(named) - len(plain) - len(self.other[1]) - len(self.other[2]))
            out = F.when(p.startswith(plain), both(self.unescape(named), self.unescape(rest)))
            for name, before, after in marked:
                out = out.when(p.startswith(before) & p.endswith(after), both(F.lit(name), inner(before, after)))
            return out

        return F.transform(pieces, turn)


def _literal(text: str) -> str:
    return "".join(c if c.isalnum() or c == "_" else "\\" + c for c in text)


def _key(column: str) -> Column:
    """A key that is never null and differs for null and the empty string."""
    text = F.col(f"`{column}`").cast("string")
    return F.when(text.isNull(), "").otherwise(F.concat(F.lit("="), text))


def paths(ids: DataFrame) -> DataFrame:
    """``ids (tree, node, parent, score)``, one row a node, to ``(tree, leaf, node, up, score)``: the nodes of all
    paths, ``up`` replies above their leaf."""
    scratch = Scratch(ids.sparkSession, "replies")
    ids = scratch.put(ids)
    most = ids.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    # a parent that is not a node is no ancestor
    have = ids.select("tree", F.col("node").alias("up"))
    jumps = [scratch.put(ids.filter("parent is not null").select("tree", "node", F.col("parent").alias("up")).join(have, ["tree", "up"], "left_semi")
                         .select("tree", "node", "up"))]
    while not jumps[-1].isEmpty() and 2 ** len(jumps) <= most:
        last = jumps[-1]
        jumps.append(scratch.put(last.alias("a").join(last.alias("b"), (F.col("a.tree") == F.col("b.tree")) & (F.col("a.up") == F.col("b.node")))
                                 .select("a.tree", "a.node", F.col("b.up").alias("up"))))
    parents = jumps[0].select("tree", F.col("up").alias("node")).distinct()
    roots = ids.select("tree", "node").join(jumps[0], ["tree", "node"], "left_anti")
    out = ids.join(parents, ["tree", "node"], "left_anti").select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up"))
    for k in range(len(jumps) - 1, -1, -1):
        jump = jumps[k].select("tree", "node", F.col("up").alias("above"))
        further = out.join(jump, ["tree", "node"]).select("tree", "leaf", F.col("above").alias("node"), (F.col("up") + 2**k).alias("up"))
        out, old = scratch.put(out.unionByName(further)), out
        scratch.drop(old, jumps[k] if k else None)
    rooted = out.join(roots, ["tree", "node"], "left_semi").select("tree", "leaf")
    done = scratch.put(out.join(rooted, ["tree", "leaf"], "left_semi").join(ids.select("tree", "node", "score"), ["tree", "node"])
                       .select("tree", "leaf", "node", "up", "score"))
    scratch.drop(out, ids, jumps[0])
    return done


def branches(walks: DataFrame, keep: int = 1) -> DataFrame:
    """``(tree, leaf, branch_score, rank)`` of the ``keep`` best branches of every tree: highest mean score of the
    nodes (null: 0), then the longer one, then the smaller leaf key."""
    scored = walks.groupBy("tree", "leaf").agg((F.sum(F.coalesce("score", F.lit(0.0))) / F.count("*")).alias("branch_score"), F.count("*").alias("n"))
    best = Window.partitionBy("tree").orderBy(F.desc("branch_score"), F.desc("n"), "leaf")
    return scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= keep).select("tree", "leaf", "branch_score", "rank")


def own_links(nodes: DataFrame, tree: str, node: str, parent: str, score: str | None = None) -> DataFrame:
    """Links of rows that name their parent; of repeated nodes the smallest parent and the highest score count."""
    value = F.col(f"`{score}`").cast("double") if score else F.lit(0.0)
    up = F.when(F.col(f"`{parent}`").isNotNull(), _key(parent))
    return nodes.groupBy(_key(tree).alias("tree"), _key(node).alias("node")).agg(F.min(up).alias("parent"), F.max(value).alias("score"))


def chain_links(rows: DataFrame, tree: str, order: str) -> DataFrame:
    """Links of linear conversations: every distinct ``order`` value replies to the one before it, null comes first."""
    steps = rows.select(_key(tree).alias("tree"), F.col(f"`{order}`").alias("order")).distinct()
    before = F.lag("node").over(Window.partitionBy("tree").orderBy("order"))
    return steps.withColumn("node", _key("order")).select("tree", "node", before.alias("parent"), F.lit(0.0).alias("score"))


def format_trees(turns: DataFrame, links: DataFrame, tree: str, node: str, role: str, text: str, keep: int = 1,
                 template: Template = Template()) -> DataFrame:
    """One row for each of the ``keep`` best branches of every tree in ``links``: the tree column, ``rank``,
    ``branch_score``, ``n_turns``, ``formatted`` and ``segments``, whose texts joined are ``formatted`` and which say
    what counts for the loss."""
    scratch = Scratch(turns.sparkSession, "branches")
    walks = paths(links)
    chosen = scratch.put(walks.join(branches(walks, keep), ["tree", "leaf"]).select("tree", "leaf", "node", "up", "branch_score", "rank"))
    sizes = scratch.put(turns.groupBy(_key(tree).alias("tree")).count())
    total = sizes.agg(F.sum("count")).first()[0] or 0
    # 1 / HOT_SHARE rows at most
    hot = F.broadcast(scratch.put(sizes.filter(F.col("count") >= max(HOT_ROWS, HOT_SHARE * total)).select("tree")))
    turn = F.struct(F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    step = F.struct("leaf", "up", "rank", "branch_score")
    held = (turns.select(_key(tree).alias("tree"), _key(node).alias("node"), F.col(f"`{tree}`").alias("__tree"), turn.alias("turn"))
            .unionByName(chosen.select("tree", "node", step.alias("step")), allowMissingColumns=True))
    # dealt by tree, so that both groupings need no other shuffle of the texts
    out = _assemble(held.join(hot, "tree", "left_anti").repartition("tree"), template, tree)
    if not hot.isEmpty():
        out = out.unionByName(_assemble(held.join(hot, "tree", "left_semi"), template, tree))
    return out


def _assemble(held: DataFrame, template: Template, tree: str) -> DataFrame:
    nodes = held.groupBy("tree", "node").agg(F.first("__tree", ignorenulls=True).alias("__tree"), F.collect_list("turn").alias("said"),
                                             F.collect_list("step").alias("steps"))
    place = F.struct((-F.col("step.up")).alias("place"), F.array_sort("said").alias("said"))
    held = (nodes.select("tree", "__tree", "said", F.explode("steps").alias("step")).groupBy("tree", F.col("step.leaf").alias("leaf"))
            .agg(F.first("__tree", ignorenulls=True).alias("__tree"), F.first("step.rank").alias("rank"), F.first("step.branch_score").alias("branch_score"),
                 F.array_sort(F.collect_list(place)).alias("__places"))
            .withColumn("__turns", F.flatten(F.transform("__places", lambda p: p["said"]))))
    segments = F.concat(F.array(F.struct(F.lit(template.begin).alias("text"), F.lit(False).alias("loss"))),
                        F.flatten(F.transform("__turns", lambda t: template.segments(t["role"], t["text"]))))
    return (held.withColumn("segments", segments)
            .select(F.col("__tree").alias(tree), "rank", "branch_score", F.size("__turns").cast("long").alias("n_turns"),
                    F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments"))


def read_back(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """``turns`` and ``trained`` (all text under the loss mask) as the output holds them, beside its columns."""
    trained = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: template.unescape(s["text"])), "")
    return formatted.withColumn("turns", template.parse(F.col("formatted"))).withColumn("trained", trained)
