"""Fuzzy line deduplication with built-in functions only."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from tessel.llm.graph import components
from tessel.llm.scratch import Scratch, keep_keys

#: Edit similarity: 1 - distance / longer length.
SIMILARITY = 0.8
#: Hamming radius of SimHash candidates: the share of bits that the similarity leaves free.
RADIUS = int(64 * (1 - SIMILARITY))
#: Bits of the five blocks. Candidates have two equal blocks: all pairs up to three bits apart do, and many beyond.
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
#: Lines that share a block pair meet one leader first. What it leaves apart is paired up to this many lines; above, further leaders follow.
BUCKET = 64
#: Rounds of leaders before what is still apart is paired.
ROUNDS = 6
#: Words of a line are told apart by the stretch of this many words they stand in; shorter lines have one stretch.
STRETCH = 512
#: Limits an edit distance is tried with, smallest first, before the whole allowance: close lines end at the first.
LIMITS = (8, 32, 128, 512, 2048, 8192)

#: Upper bounds of the distance that cost one pass: the longer length, and words compared place by place. Within the allowance
#: they settle a pair; they never refuse one.
SURE = """when greatest(length(s.x), length(s.y)) <= most then true
  when size(split(s.x, ' ', -1)) = size(split(s.y, ' ', -1))
    and aggregate(zip_with(split(s.x, ' ', -1), split(s.y, ' ', -1), (v, w) -> if(v = w, 0, levenshtein(v, w))), 0, (d, e) -> d + e) <= most then true"""


def normal(line: Column) -> Column:
    """Lower case, without blanks at the ends."""
    return F.trim(F.lower(line))


def lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``(doc, line, norm)`` of every line that is not blank."""
    return _split(docs.select(F.col(f"`{key}`").cast("long").alias("doc"), F.col(f"`{text}`").cast("string").alias("text")))


def _split(texts: DataFrame) -> DataFrame:
    each = texts.select("doc", F.posexplode(F.split("text", "\n", -1)).alias("line", "raw"))
    return each.select("doc", "line", normal(F.col("raw")).alias("norm")).filter("norm <> '' and doc is not null")


#: Votes are added in lanes of this many bits, several to a long, up to so many distinct words.
LANES = ((8, 127), (16, 32767), (32, 2**31 - 1))
#: Lane k of sum i holds the votes for bit ``i + width * k``. The expressions stay small, so that the stage is compiled.
VOTES = "transform(sequence(0, width - 1), i -> aggregate(hs, 0L, (sum, h) -> sum + (shiftrightunsigned(h, i) & ones)))"
#: A lane that outvotes half of the words, ``tie`` added, carries into its highest bit. The top lane is decided by
#: itself, as a carry there would leave the long.
DECIDED = """aggregate(transform(sums, (s, i) -> shiftleft(
  (shiftrightunsigned((s & inner) + half * (ones & inner) + (shiftrightunsigned(tie, i) & ones & inner), width - 1) & ones & inner)
  | shiftleft(shiftrightunsigned(shiftrightunsigned(s, 64 - width) + half + (shiftrightunsigned(tie, i + 64 - width) & 1), width - 1), 64 - width),
  i)), 0L, (sim, bits) -> sim | bits)"""


def _by_width(value) -> Column:
    """``value(width)`` for the lanes that hold ``n`` votes."""
    picks = [(F.col("n") <= most, F.lit(value(width))) for width, most in LANES]
    return reduce(lambda rest, pick: F.when(pick[0], pick[1]).otherwise(rest), reversed(picks[:-1]), picks[-1][1])


def fingerprints(split: DataFrame) -> DataFrame:
    """``(doc, line, h1, h2, size, sim)``: exact code, length and 64-bit SimHash of the distinct words of each line.

    A word counts as another one in each stretch of STRETCH words, so long lines over one vocabulary stay
    apart unless their words stand in a like order. Word hashes vote bit by bit; the smallest one decides ties.
    """
    coded = split.select("doc", "line", F.xxhash64("norm").alias("h1"), F.xxhash64(F.lit(1), "norm").alias("h2"),
                         F.length("norm").alias("size"),
                         F.array_distinct(F.transform(F.split("norm", " ", -1), lambda w, i: F.xxhash64(w, (i / STRETCH).cast("int")))).alias("hs"))
    n = F.size("hs")
    counted = coded.select("*", n.alias("n"), F.when(n % 2 == 0, F.array_min("hs")).otherwise(F.lit(0).cast("long")).alias("tie"))
    ones = _by_width(lambda width: sum(1 << width * k for k in range(64 // width)))
    laid = counted.select("*", _by_width(lambda width: width).alias("width"), ones.alias("ones"),
                          _by_width(lambda width: (1 << 64 - width) - 1).alias("inner"),
                          (_by_width(lambda width: (1 << width - 1) - 1) - F.shiftright("n", 1)).cast("long").alias("half"))
    voted = laid.select("doc", "line", "h1", "h2", "size", "tie", "width", "ones", "inner", "half", F.expr(VOTES).alias("sums"))
    return voted.select("doc", "line", "h1", "h2", "size", F.expr(DECIDED).alias("sim"))


def block_keys(sim: Column) -> Column:
    """The ten pairs of blocks of a fingerprint, each with its number, as longs."""
    def block(i):
        return F.shiftrightunsigned(sim, BLOCKS[i][0]).bitwiseAND(F.lit((1 << BLOCKS[i][1]) - 1))
    return F.array(*[F.shiftleft(F.lit(n).cast("long"), 32).bitwiseOR(F.shiftleft(block(a), 13)).bitwiseOR(block(b))
                     for n, (a, b) in enumerate(combinations(range(5), 2))])


def _near(a: Column, b: Column, similarity: float) -> Column:
    """Fingerprints within the radius, and lengths that the edit similarity allows."""
    return ((F.bit_count(a["sim"].bitwiseXOR(b["sim"])) <= RADIUS)
            & (F.abs(a["size"] - b["size"]) <= (1 - similarity) * F.greatest(a["size"], b["size"])))


def _trimmed(x: str, y: str) -> str:
    """SQL for an array of one struct: texts ``x`` and ``y`` without what both begin and end with, reversed.

    No edit distance depends on what goes. The common length is searched in halving steps. Each step reads
    the struct of the one before, so that nothing is worked out twice.
    """
    steps = ", ".join(str(1 << k) for k in range(20, -1, -1))
    held = f"array(named_struct('x', {x}, 'y', {y}))"
    for _ in range(2):
        same = f"aggregate(array({steps}), 0, (p, k) -> if(substring(s.x, p + 1, k) = substring(s.y, p + 1, k), p + k, p))"
        held = f"transform({held}, s -> named_struct('x', s.x, 'y', s.y, 'n', {same}))"
        held = f"transform({held}, s -> named_struct('x', reverse(substring(s.x, s.n + 1)), 'y', reverse(substring(s.y, s.n + 1))))"
    return held


def _close(pairs: DataFrame, texts: DataFrame, similarity: float, scratch: Scratch) -> DataFrame:
    """``(a, b)``: ids of the pairs of lines ``(x, y)`` whose texts pass the edit similarity; texts are read for these alone."""
    near = scratch.put(pairs.dropDuplicates(["x", "y"]))
    wanted = scratch.put(near.select("x.doc", "x.line").unionAll(near.select("y.doc", "y.line")).distinct())
    owners = scratch.put(wanted.select("doc").distinct())
    held = scratch.put(_split(keep_keys(texts, owners, ["doc"])).join(wanted, ["doc", "line"]).dropDuplicates(["doc", "line"]))
    p, q = (held.select(F.col("doc").alias(f"doc_{s}"), F.col("line").alias(f"line_{s}"), F.col("norm").alias(f"norm_{s}")) for s in "xy")
    limit = F.floor((1 - similarity) * F.greatest("x.size", "y.size")).cast("int")
    met = near.select(F.col("x.id").alias("a"), F.col("y.id").alias("b"), limit.alias("most"), *[
        F.col(f"{s}.{c}").alias(f"{c}_{s}") for s in "xy" for c in ("doc", "line")])
    met = met.join(p, ["doc_x", "line_x"]).join(q, ["doc_y", "line_y"]).select("a", "b", "most", "norm_x", "norm_y")
    # few bytes but long work: one task a shuffle partition, however small
    met = met.repartition(int(near.sparkSession.conf.get("spark.sql.shuffle.partitions")), "a", "b")
    tries = " ".join(f"when most > {n} and levenshtein(s.x, s.y, {n}) >= 0 then true" for n in LIMITS)
    alike = F.expr(f"exists({_trimmed('norm_x', 'norm_y')}, s -> case {SURE} {tries} else levenshtein(s.x, s.y, most) >= 0 end)")
    out = scratch.put(met.filter(alike).select("a", "b"))
    scratch.drop(near, wanted, owners, held)
    return out


def _tied(classes: DataFrame, edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``classes (id, component)`` after more ``edges (a, b)``; only classes that an edge ends in are worked on."""
    ends = edges
    for c in "ab":
        side = classes.select(F.col("id").alias(c), F.col("component").alias("label"))
        ends = ends.join(side, c, "left").withColumn(c, F.coalesce("label", c)).drop("label")
    merged = components(ends, scratch)
    named = merged.select(F.col("id").alias("component"), F.col("component").alias("whole"))
    moved = classes.join(named, "component", "left").select("id", F.coalesce("whole", "component").alias("component"))
    out = scratch.put(moved.unionAll(merged.join(classes.select("id"), "id", "left_anti").select("id", "component")))
    scratch.drop(merged)
    return out


def line_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY,
                 scratch: Scratch | None = None) -> tuple[DataFrame, DataFrame]:
    """All lines ``(doc, line, h1, h2, ...)`` and the lines to keep ``(doc, line)``.

    Lines with equal normal form are one; different ones are linked if two blocks of their SimHash are equal,
    it differs in at most RADIUS bits and their edit similarity reaches the threshold. Lines that share a block
    pair are compared with the first of them, so links grow with the lines and not with their pairs; those of
    different classes are then paired, in large buckets after ROUNDS leaders. The first line (smallest document,
    then line number) of each connected class is kept.
    """
    scratch = scratch or Scratch(docs.sparkSession, "lines")
    texts = docs.select(F.col(f"`{key}`").cast("long").alias("doc"), F.col(f"`{text}`").cast("string").alias("text"))
    every = scratch.put(fingerprints(_split(texts)))
    first = every.groupBy("h1", "h2").agg(F.min(F.struct("doc", "line")).alias("at"), F.max("sim").alias("sim"), F.max("size").alias("size"))
    found = scratch.put(first.select("at.doc", "at.line", "sim", "size", F.monotonically_increasing_id().alias("id")))
    me = F.struct("id", "sim", "size", "doc", "line")
    keys = found.select("id", F.explode(block_keys(F.col("sim"))).alias("key"))
    # counted before the shuffle, so a key of very many lines is a few rows; two members are known by smallest and sum
    sums = scratch.put(keys.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("low"), F.try_sum("id").alias("total")).filter("n > 1"))
    few = sums.filter("n = 2").select(F.col("low").alias("a"), (F.col("total") - F.col("low")).alias("b"))
    x, y = (found.select(F.col("id").alias(i), me.alias(s)) for i, s in ("ax", "by"))
    few = few.distinct().join(x, "a").join(y, "b").select("x", "y")
    many = scratch.put(sums.filter("n > 2").select("key"))
    busy = scratch.put(found.select(me.alias("me"), F.explode(block_keys(F.col("sim"))).alias("key")).transform(
        lambda d: keep_keys(d, many, ["key"])))
    scratch.drop(many)
    close = _near(F.col("x"), F.col("y"), similarity)
    met = scratch.put(busy.join(busy.groupBy("key").agg(F.min("me").alias("lead"), F.count("*").alias("n")), "key"))
    scratch.drop(busy)

    def led(rows):
        return rows.filter("me.id <> lead.id").select(F.least("me", "lead").alias("x"), F.greatest("me", "lead").alias("y"))

    def apart(rows):
        return rows.select("key", F.col("me").alias("x"), F.col("label").alias("s")).join(
            rows.select("key", F.col("me").alias("y"), F.col("label").alias("t")), "key").filter("x.id < y.id and s <> t").select("x", "y")

    pairs, classes, mixed = few.unionAll(led(met)), None, None
    for turn in range(ROUNDS + 1):
        edges = _close(pairs.filter(close), texts, similarity, scratch)
        if classes is None:
            classes = components(edges, scratch)
        elif not edges.isEmpty():
            fresh = _tied(classes, edges, scratch)
            scratch.drop(classes)
            classes = fresh
        scratch.drop(edges, sums, mixed)
        if turn == ROUNDS or met.isEmpty():
            break
        # whole rows are moved for the buckets alone that lie in several classes
        named = met.select("key", F.col("me.id").alias("id")).join(classes, "id", "left").select("key", F.coalesce("component", "id").alias("label"))
        tally = named.groupBy("key", "label").agg(F.count("*").alias("c"))
        tally = tally.groupBy("key").agg(F.max_by("label", F.struct("c", "label")).alias("main"), F.count("*").alias("labels")).filter("labels > 1")
        torn = scratch.put(tally.select("key", "main"))
        rest = keep_keys(met, torn.select("key"), ["key"]).select("key", "n", "me", "lead", F.col("me.id").alias("id"))
        mixed = scratch.put(rest.join(classes, "id", "left").select(
            "key", "n", "me", "lead", F.coalesce("component", "id").alias("label")).join(torn, "key"))
        scratch.drop(met, torn)
        if mixed.isEmpty():
            break
        # the next leader of a large bucket: the first line outside its largest class
        large = mixed.filter(F.col("n") > BUCKET)
        lead = large.filter("label <> main").groupBy("key").agg(F.min("me").alias("lead"))
        met = scratch.put(large.drop("lead").join(lead, "key").select("key", "n", "me", "lead", "label"))
        small = mixed.filter(F.col("n") <= BUCKET)
        pairs = apart(met) if turn + 1 == ROUNDS else led(met)
        pairs = pairs.unionAll(apart(small.filter("me.id <> lead.id"))) if turn == 0 else pairs
    kept = found.join(classes, "id", "left").groupBy(F.coalesce("component", "id").alias("c")).agg(F.min(F.struct("doc", "line")).alias("at"))
    kept = scratch.put(kept.select("at.doc", "at.line"))
    scratch.only(every, kept)
    return every, kept


def removed_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY,
                  scratch: Scratch | None = None) -> DataFrame:
    """``(doc, n_lines, removed)``: for each document with lines, their number and the sorted numbers of those to go.

    Line numbers count from 0. Blank lines are neither counted nor removed; null and
    empty texts and null keys have no row. A key that is repeated has one row over all its texts.
    """
    every, kept = line_classes(docs, key, text, similarity, scratch)
    state = every.select("doc", "line").join(kept.withColumn("keep", F.lit(1)), ["doc", "line"], "left")
    return state.groupBy("doc").agg(F.count("*").alias("n_lines"),
                                    F.sort_array(F.collect_set(F.when(F.col("keep").isNull(), F.col("line")))).alias("removed"))


def drop_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` without the lines that repeat earlier ones; documents left without any line go.

    All columns stay; other texts (null, empty, blank) stay as they are.
    """
    scratch = Scratch(docs.sparkSession, "gone")
    gone = scratch.put(removed_lines(docs, key, text, similarity, scratch).filter("size(removed) > 0"))
    scratch.only(gone)
    gone = gone.select(F.col("doc").alias("__doc"), F.col("n_lines").alias("__n"), F.col("removed").alias("__gone"))
    split = F.split(F.col(f"`{text}`"), "\n", -1)
    left = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("__gone"))
    shorter = F.array_join(F.transform(left, lambda i: F.get(split, i)), "\n")
    out = docs.join(gone, F.col(f"`{key}`") == F.col("__doc"), "left").filter("__gone is null or size(__gone) < __n")
    return out.select(*[(F.when(F.col("__gone").isNull(), F.col(f"`{c}`")).otherwise(shorter).alias(c) if c == text
                         else F.col(f"`{c}`")) for c in docs.columns])
