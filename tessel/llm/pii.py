"""Personal data: fixed patterns, and identifiers found through contexts learned from them."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessel.llm.scratch import Scratch

#: Kinds in their order.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)+")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: What may be an identifier: an address with an "at" of any spelling; six or more digits in groups, perhaps with blanks, brackets
#: and "+"; a word of letters or digits with a digit and at least six characters, perhaps joined by marks.
_CANDIDATE = re.compile(r"""
    (?P<address>(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}
        (?:(?:@|\ ?[\[(]\ ?(?:at|AT|@)\ ?[\])]\ ?)[A-Za-z0-9-]+(?:(?:\.|\ ?[\[(]\ ?(?:dot|DOT|\.)\ ?[\])]\ ?|\ (?:dot|DOT)\ )[A-Za-z0-9-]+)*
        |\ (?:at|AT|@)\ [A-Za-z0-9-]+(?:(?:\.|\ (?:dot|DOT)\ )[A-Za-z0-9-]+)+))
    |(?P<digits>(?<![A-Za-z0-9])[+(]{0,2}[0-9](?:[\ ().+/-]{0,3}[0-9]){5,}(?![A-Za-z0-9_]))
    |[A-Za-z0-9][A-Za-z0-9_./:+-]*[A-Za-z0-9]""", re.VERBOSE)
#: Texts without a match hold neither seeds nor candidates.
_ANY = r"[0-9@]|\b(?:at|AT)\b"
_WORD_BEFORE, _WORD_AFTER = re.compile(r"(\S+)\s+$"), re.compile(r"\s+(\S+)")
#: Rounds of pattern and instance scoring.
ROUNDS = 3
#: A pattern counts with this many distinct instances at least.
SUPPORT = 3
#: Confidence at which a pattern's instances become spans.
CONFIDENCE = 0.8


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)``, leftmost and non-overlapping within each kind, by start and then kind."""
    out = []
    at, end = text.find("@"), 0
    while at >= 0:
        m = _DOMAIN.match(text, at)
        if m:
            a = at
            while a > end and text[a - 1] in _LOCAL:
                a -= 1
            if a < at:
                out.append((a, m.end(), "email"))
                end = m.end()
        at = text.find("@", max(at + 1, end))
    for m in _DOTTED.finditer(text):
        parts, a = m.group().split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            size = sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in four):
                out.append((a, a + size, "ip"))
            a += size + 1
    for m in _DIGITS.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and _luhn(digits):
            out.append((m.start(), m.end(), "card"))
    for m in _PHONE.finditer(text):
        if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def _candidates(text: str, seeds: list[tuple[int, int, str]]):
    """Bounds of what may be an identifier between the seeds and touches none of them."""
    at = 0
    for low, high in [(s[0], s[1]) for s in seeds] + [(len(text), len(text))]:
        for m in _CANDIDATE.finditer(text, at, low) if at < low else ():
            word = m.group()
            if not m.lastgroup and (len(word) < 6 or not any(c.isdigit() for c in word)):
                continue
            if (at == 0 or m.start() > at) and (low == len(text) or m.end() < low):
                yield m.span()
        at = max(at, high)


def mentions(text: str) -> list[tuple[int, int, str, str, str]]:
    """``(start, end, kind or "", instance, pattern)`` of seeds and of what may be an identifier.

    A pattern is the word before or the word after a mention, and whether the mention has letters; its form
    is no part of it. A mention has up to two patterns, joined by a line feed.
    """
    seeds = base_spans(text)
    out = []
    for a, b, kind in [*seeds, *((a, b, "") for a, b in _candidates(text, seeds))]:
        before = _WORD_BEFORE.search(text[max(0, a - 48):a])
        after = _WORD_AFTER.match(text, b, b + 48)
        letters = "a" if any(c.isalpha() for c in text[a:b]) else "9"
        near = [f"{side} {m.group(1).lower()} {letters}" for side, m in (("L", before), ("R", after)) if m]
        out.append((a, b, kind, text[a:b], "\n".join(near)))
    return out


def _mentions(batches):
    for batch in batches:
        rows = {"row": [], "start": [], "stop": [], "kind": [], "instance": [], "pattern": []}
        for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if text and _maybe(text):
                for found in mentions(text):
                    for name, value in zip(rows, (row, *found)):
                        rows[name].append(value)
        yield pa.RecordBatch.from_pydict({"row": pa.array(rows["row"], pa.int64()), "start": pa.array(rows["start"], pa.int32()),
                                          "stop": pa.array(rows["stop"], pa.int32()), **{c: pa.array(rows[c], pa.string()) for c in ("kind", "instance", "pattern")}})


def _maybe(text: str) -> bool:
    return re.search(_ANY, text) is not None


def learn(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``(pattern, kind, confidence)`` of patterns that seeds induce, scored over the pattern-instance graph.

    A seed instance has confidence 1 for its kind. In each round a pattern's confidence for a kind is the mean over its
    distinct instances (0 for unknown ones), an instance's the largest over its patterns.
    """
    found = docs.mapInArrow(_mentions, "row long, start int, stop int, kind string, instance string, pattern string")
    edges = found.select("kind", "instance", F.explode(F.split("pattern", "\n")).alias("pattern")).filter("pattern <> ''").distinct()
    edges = scratch.put(edges.select("kind", "pattern", F.xxhash64("instance").alias("instance")).distinct())
    seeds = edges.filter("kind <> ''").select("instance", "kind", F.lit(1.0).alias("c")).distinct()
    graph = edges.select("pattern", "instance").distinct()
    size = graph.groupBy("pattern").agg(F.count("*").alias("n")).filter(F.col("n") >= SUPPORT)
    belief, patterns = seeds, None
    for _ in range(ROUNDS):
        score = graph.join(belief, "instance").groupBy("pattern", "kind").agg(F.sum("c").alias("c"))
        patterns = scratch.put(score.join(size, "pattern").select("pattern", "kind", (F.col("c") / F.col("n")).alias("confidence")).filter("confidence >= 0.2"))
        new = graph.join(patterns, "pattern").groupBy("instance", "kind").agg(F.max("confidence").alias("c"))
        belief = scratch.put(seeds.unionAll(new).groupBy("instance", "kind").agg(F.max("c").alias("c")))
    good = patterns.filter(F.col("confidence") >= CONFIDENCE)
    return scratch.put(good.groupBy("pattern").agg(F.max(F.struct("confidence", "kind")).alias("best")).select("pattern", "best.kind", "best.confidence"))


def _base(batches):
    for batch in batches:
        found = [base_spans(t) if t and _maybe(t) else [] for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_pydict({
            "id": batch.column(0), "row": batch.column(2),
            **{f"n_{k}": pa.array([sum(s[2] == k for s in x) for x in found], pa.int64()) for k in KINDS},
            "base": pa.array([",".join(f"{k}:{a}:{b}" for a, b, k in x) for x in found])})


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_email, n_ip, n_card, n_phone, base, base_sha256, spans)`` for every row of ``docs``.

    ``spans`` adds to the base spans those of learned patterns, named ``like_<kind>``, by start, then kind. Null
    texts count as empty; rows that repeat a key share the learned spans of its texts.
    """
    scratch = Scratch(docs.sparkSession, "pii")
    plain = docs.select(F.col(f"`{key}`").alias("id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("t"))
    coded = plain.select(F.col("id").cast("long").alias("row"), "t").filter(F.col("t").rlike(_ANY))
    found = coded.mapInArrow(_mentions, "row long, start int, stop int, kind string, instance string, pattern string")
    patterns = learn(coded, scratch)
    more = found.filter("kind = ''").select("row", "start", "stop", F.explode(F.split("pattern", "\n")).alias("pattern"))
    more = more.join(patterns, "pattern").groupBy("row", "start", "stop").agg(F.max(F.struct("confidence", "kind")).alias("b"))
    more = more.groupBy("row").agg(F.collect_list(F.struct("start", F.concat(F.lit("like_"), "b.kind").alias("kind"), "stop")).alias("more"))
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    base = plain.select("id", "t", F.col("id").cast("long").alias("row")).mapInArrow(
        _base, f"id {plain.schema['id'].dataType.simpleString()}, row long, {counts}, base string")
    both = base.join(scratch.put(more), "row", "left")
    parsed = F.transform(F.filter(F.split("base", ","), lambda s: s != ""), lambda s: F.struct(
        F.split(s, ":")[1].cast("int").alias("start"), F.element_at(F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, f"{i}{k}")]), F.split(s, ":")[0]).alias("kind"),
        F.split(s, ":")[2].cast("int").alias("stop")))
    every = F.array_sort(F.concat(parsed, F.transform(F.coalesce("more", F.array().cast("array<struct<start:int,kind:string,stop:int>>")),
                                                      lambda m: F.struct(m["start"].alias("start"), F.concat(F.lit("9"), m["kind"]).alias("kind"), m["stop"].alias("stop")))))
    spans = F.array_join(F.transform(every, lambda s: F.concat_ws(":", F.substring(s["kind"], 2, 99), s["start"].cast("string"), s["stop"].cast("string"))), ",")
    return both.select(F.col("id").alias(key), *[f"n_{k}" for k in KINDS], "base", F.sha2("base", 256).alias("base_sha256"), spans.alias("spans"))
