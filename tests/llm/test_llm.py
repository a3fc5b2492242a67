"""The ten operators and the pipeline against brute force, on edge cases and small tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from checks.compare import difference, duck, spark_rows, sql_rows
from tessel.llm import balltree, bpe, editcount, graph, pii, setscan, simline
from tessel.llm import queries as q
from tessel.llm.chosenpath import LEVELS, _branch, similar_classes
from tessel.llm.scratch import Scratch, reach
from tessel.llm.simwindow import find_passages
from tessel.llm.suffixtree import score_texts
from tessel.llm.toxic import ToxicityModel

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id int, n int"
WHITE = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [w for w in WHITE.split(lower) if w]


@pytest.fixture(scope="module")
def edge(spark):
    """Nulls, blanks, repeats, a long text, and extra columns with clashing names."""
    reach(spark)
    long = " ".join(f"w{i % 977}x{i % 13}" for i in range(20_000))
    texts = [None, "", "   \n\t ", "one two", "one two", "A b C d e f g", "a b c d e f g", long, long + " end", "Licensed under the MIT License.\nok"]
    rows = [(i, t, "en", "s", None, 7, None) for i, t in enumerate(texts)] + [(3, "one two", None, None, 1, 1, 1), (None, "x y", None, None, 1, 1, 1)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    reach(spark)
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", sorted(q.ORACLES))
def test_query_matches_sql(spark, name):
    assert difference(spark_rows(q.QUERIES[name](spark, SF)), sql_rows(duck(SF), q.ORACLES[name])) is None


def test_components(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)]
    root = {x: x for p in pairs for x in p if p[0] != p[1]}
    for _ in root:
        for a, b in pairs:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    got = graph.components(spark.createDataFrame(pairs, "a long, b long"), Scratch(spark, "t")).collect()
    assert {r["id"]: r["component"] for r in got} == root
    assert graph.components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "t")).count() == 0


def test_ball_tree_is_exact():
    rng = np.random.default_rng(1)
    x = rng.integers(-40, 40, (900, 8)).astype(float)
    x[300:600] = x[0]
    tree = balltree.grow(x, np.arange(900), leaf=16)
    score, found = balltree.search(tree, x[::30], np.arange(0, 900, 30), np.full(30, -np.inf), 5)
    for row, own in enumerate(range(0, 900, 30)):
        want = sorted((-int(x[own] @ x[i]), i) for i in range(900) if i != own)[:5]
        assert [(-int(s), int(i)) for s, i in zip(score[row], found[row])] == want


def test_top_k_edges(spark):
    rows = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0]), (3, []), (4, None)], "id long, vec array<double>")
    got = balltree.exact_topk(rows, rows, k=5).orderBy("query_id").collect()
    assert [tuple(r) for r in got] == [(1, 1, 2, 1), (2, 1, 1, 1)]
    assert balltree.exact_topk(rows.limit(0), rows.limit(0)).count() == 0


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(q.tokenizer_path())


def test_bpe_equals_library(spark, edge, library, tmp_path):
    rng = random.Random(1)
    alphabet = " \t\n\r'  sdtmrevl.,!?1２³éñ漢字😀​　\x1c\x85"
    texts = ["", "a" * 3000, " " * 300, "<|endoftext|>x<|endoftext|>", "don't we'll 'sabc !'s \n's"] + [
        "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(800)]
    model = bpe.Merges(q.tokenizer_path())
    some = {w: model.merge(w) for t in texts[:200] for w in t.encode().split() if w}
    bpe.compile_lexicon(some, str(tmp_path / "lexicon"))
    enc = bpe.Encoder(q.tokenizer_path(), str(tmp_path / "lexicon"))
    assert all(enc.lexicon.get(w) == ids for w, ids in some.items()) and enc.lexicon.get(b"\xffnone") is None
    ids = enc.encode_many([t.encode() for t in texts])
    for i, t in enumerate(texts):
        want = library.encode(t, add_special_tokens=False).ids
        assert ids.flat[ids.off[i]:ids.off[i + 1]].tolist() == want
    assert [t.decode() for t in enc.decode_many(ids)] == texts
    lexicon = bpe.build_lexicon(edge, q.tokenizer_path())
    for r in bpe.encode(edge, q.tokenizer_path(), lexicon, "ids array<long>, decoded string", bpe.ids_and_text).join(edge.select("doc_id", "text"), "doc_id").collect():
        assert r["ids"] == library.encode(r["text"] or "", add_special_tokens=False).ids and r["decoded"] == (r["text"] or "")


def test_op5_digests(spark, library):
    text = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    for r in q.QUERIES["op5_bpe_lexicon"](spark, SF).collect():
        ids = library.encode(text[r["doc_id"]], add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(text[r["doc_id"]].encode()).hexdigest()


def test_edit_counts_equal_full_encoding(spark, edge, library):
    library.encode_special_tokens = True
    count = editcount.counter(bpe.Encoder(q.tokenizer_path(), None))
    rng = random.Random(5)

    def some(n):
        return "".join(rng.choice(" \n'sredabc.,! 12é漢") for _ in range(n))
    for k in range(150):
        text = some(rng.randint(0, 900))
        tree = editcount.SegmentTree(text, count)
        for _ in range(5):
            a = rng.randint(0, len(text) + 3)
            b, new = a + rng.choice([0, 1, 2, 5, 300]), some(rng.choice([0, 1, 2, 30, 1500 if k % 40 == 0 else 7]))
            low, high = min(a, len(text)), min(b, len(text))
            text = text[:low] + new + text[max(low, high):]
            tree.edit(a, b, new)
            assert tree.text() == text and tree.total == len(library.encode(text, add_special_tokens=False).ids)
    library.encode_special_tokens = False
    got = editcount.count_edits(edge.withColumn("edits", F.expr("array(null, named_struct('start', 1, 'stop', null, 'text', 'hi'))")), q.tokenizer_path())
    assert got.filter("n_chars_after < 2").count() == 0 and got.count() == 12
    assert q.QUERIES["op6_edit_counts"](spark, SF).filter("n_chars_encoded > n_chars_after + 200").count() == 0


def shingle_sets(rows):
    out = {}
    for d, t in rows:
        w = words(t)
        out[d] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    return out


def brute_classes(rows, percent):
    sets = shingle_sets(rows)
    root = {d: d for d in sets}
    for _ in range(4):
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b]) if a < b else 0
                if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    root[a] = root[b] = min(root[a], root[b])
    return {d: (len(sets[d]), root[d]) for d in sets}


@pytest.mark.parametrize("leaf", [1024, 4])
def test_near_duplicates(spark, edge, empty, leaf, monkeypatch):
    monkeypatch.setattr("tessel.llm.chosenpath.LEAF", leaf)
    rng = random.Random(2)
    seed = [f"t{rng.randrange(400)}" for _ in range(120)]
    rows = []
    for i in range(60):
        copy = list(seed)
        for _ in range(rng.choice([0, 1, 2, 4])):
            copy[rng.randrange(len(copy))] = f"z{rng.randrange(999)}"
        rows.append((i, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in similar_classes(docs).collect()}
    assert got == brute_classes(rows, 85)
    got = [tuple(r) for r in similar_classes(edge).collect()]
    assert (4, 1, 3, False) in got and (6, 3, 5, False) in got and (0, 0, 0, True) in got and (None, 1, None, True) in got
    assert [r for r in got if r[0] == 8][0][2] == 7
    assert similar_classes(empty).count() == 0


def near_copies():
    rng = random.Random(2)
    seed = [f"t{rng.randrange(400)}" for _ in range(120)]
    rows = []
    for i in range(60):
        copy = list(seed)
        for _ in range(rng.choice([0, 1, 2, 4])):
            copy[rng.randrange(len(copy))] = f"z{rng.randrange(999)}"
        rows.append((i, " ".join(copy)))
    return rows


def test_blocks_of_a_mixed_node_meet(spark, monkeypatch):
    """Near copies of which many stay apart: a node of few blocks ends without branching."""
    def fail(*_):
        raise AssertionError("branched")

    monkeypatch.setattr("tessel.llm.chosenpath.LEAF", 8)
    monkeypatch.setattr("tessel.llm.chosenpath._branch", fail)
    rows = near_copies()
    made = similar_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in made.collect()} == brute_classes(rows, 85)


def test_stars_need_no_round(spark, monkeypatch):
    """Edges that are stars already are not worked on again; a chain is."""
    rounds, plain = [], graph._stars
    monkeypatch.setattr(graph, "_stars", lambda *a, **k: rounds.append(1) or plain(*a, **k))
    stars = [(x, 0) for x in range(1, 9)] + [(10, x) for x in range(11, 14)]
    for pairs, most in ((stars[:8], 0), (stars, 2), ([(i, i + 1) for i in range(9)], 99)):
        rounds.clear()
        got = graph.components(spark.createDataFrame(pairs, "a long, b long"), Scratch(spark, "t")).collect()
        assert {r["id"]: r["component"] for r in got} == {x: 0 if x < 10 else 10 for p in pairs for x in p}
        assert len(rounds) <= most


def test_classes_grow_by_further_edges(spark):
    """Classes tied by later edges, which only the touched classes take part in, equal those of all edges at once."""
    rng = random.Random(4)
    first, more = ([(rng.randrange(90), rng.randrange(90)) for _ in range(n)] for n in (40, 30))
    scratch = Scratch(spark, "t")
    made = [spark.createDataFrame(x, "a long, b long") for x in (first, more)]
    got = simline._tied(graph.components(made[0], scratch), made[1], scratch)
    want = graph.components(made[0].unionAll(made[1]), scratch)
    assert sorted(map(tuple, got.select("id", "component").collect())) == sorted(map(tuple, want.collect()))


def test_isolated_pairs_part_independently_in_each_node():
    """Pairs at the threshold in 12 large mixed nodes: one that parts at both branches of a node stays together in others."""
    rng = random.Random(8)
    texts = []
    for _ in range(1000):
        drawn = rng.sample(range(200), 108)
        texts += [" ".join(f"w{x}" for x in drawn[:100]), " ".join(f"w{x}" for x in drawn[8:])]
    batch = pa.RecordBatch.from_pydict({"id": pa.array(range(2000), pa.int64()), "t": pa.array(texts),
                                        "nodes": pa.array([list(range(-6, 6))] * 2000, pa.list_(pa.int64()))})
    for level in range(1, LEVELS + 1):
        path = {(r["node"], r["rep"]): r["keys"] for out in _branch(level, 1)([batch.slice(0, 700), batch.slice(700)]) for r in out.to_pylist()}
        assert len(path) == 12 * 2000
        together = np.array([[any(x == y for x, y in zip(path[node, i], path[node, i + 1])) for node in range(-6, 6)] for i in range(0, 2000, 2)])
        assert together.any(1).all() and 0.96 < together.mean() < 0.99


def test_op9_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in q.QUERIES["op9_chosen_path"](spark, SF).collect()}
    assert got == brute_classes(rows, 85)


def test_passages(spark, edge, empty):
    item = " ".join(f"b{i}" for i in range(40))
    close = item.replace("b3 ", "zz ")
    items = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "one two"), (None, "x y")], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"so {item.upper()} it"), (2, f"and {close} end"), (3, item[:80]), (4, None), (5, "go one two")], "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["start_word"], round(r["similarity"], 3)) for r in find_passages(docs, items).collect()}
    assert got == {(1, 1): (1, 1.0), (2, 1): (1, round(32 / 40, 3)), (5, 4): (1, 1.0)}
    assert {r["doc_id"] for r in find_passages(edge, items).collect()} == {3, 4}
    assert find_passages(empty, items).count() == 0 and find_passages(docs, items.limit(0)).count() == 0


def test_document_shorter_than_its_item(spark):
    item = [f"b{i}" for i in range(40)]
    items = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(item[:36]) + " x y")], "item_id long, text string")
    docs = spark.createDataFrame([(1, " ".join(item[:36])), (2, " ".join(item[3:])), (3, " ".join(item[:30])), (4, "b1 b2"),
                                  (5, " ".join(item[:34]) + " q r")], "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["start_word"], r["n_words"], round(r["similarity"], 3)) for r in find_passages(docs, items).collect()}
    sets, wanted = shingle_sets(docs.collect()), shingle_sets(items.collect())
    part = {(d, i): len(sets[d] & wanted[i]) / len(sets[d] | wanted[i]) for d in sets for i in wanted}
    assert got == {x: (0, len(sets[x[0]]) + 4, round(v, 3)) for x, v in part.items() if v >= 0.8} and (1, 1) in got and (2, 1) in got


def test_op2_query(spark):
    sets = shingle_sets([tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()])
    items = shingle_sets([tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()])
    whole = {(d, i) for d in sets for i in items if items[i] <= sets[d]}
    got = q.QUERIES["op2_simhash_windows"](spark, SF).collect()
    assert whole <= {(r["doc_id"], r["item_id"]) for r in got} and whole and all(0.8 <= r["similarity"] <= 1 for r in got)


def within(a, b, most):
    """Edit distance of ``most`` at most; replacing the words that differ is often enough to tell."""
    x, y = a.split(" "), b.split(" ")
    if len(x) == len(y) and sum(max(len(v), len(w)) for v, w in zip(x, y) if v != w) <= most:
        return True
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1] <= most


def linked(sim_a, sim_b, a, b):
    """Two of five equal blocks, at most an eighth and a half of the bits apart, edit similarity of 0.8."""
    apart = (sim_a ^ sim_b) & (2**64 - 1)
    equal = sum(not apart >> start & (1 << width) - 1 for start, width in ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12)))
    return a == b or equal >= 2 and bin(apart).count("1") <= 12 and within(a, b, int((1 - 0.8) * max(len(a), len(b))))


def test_lines(spark, edge, empty):
    base = " ".join(f"word{i}" for i in range(60))
    near = base + "x"
    rows = [(1, f"{base}\nshort\n\nother line here"), (2, f"SHORT \n{near}\nfresh"), (3, "short\nShort"), (4, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    codes = [r["sim"] for r in simline.fingerprints(simline.lines(docs, "doc_id", "text")).orderBy("doc", "line").collect()]
    hit = linked(codes[0], codes[4], base, near)
    got = {r["doc"]: (r["n_lines"], r["removed"]) for r in simline.removed_lines(docs).collect()}
    assert got == {1: (3, []), 2: (3, [0, 1] if hit else [0]), 3: (2, [0, 1])}
    kept = {r["doc_id"]: r["text"] for r in simline.drop_lines(docs).collect()}
    assert kept[2] == ("fresh" if hit else f"{near}\nfresh") and 3 not in kept and kept[4] is None and kept[5] == ""
    assert simline.drop_lines(edge).columns == edge.columns and simline.drop_lines(empty).count() == 0


def test_trimming_keeps_the_distance(spark):
    pairs = [("", ""), ("", "abc"), ("same", "same"), ("aaa", "aaaa"), ("abab", "ab"), ("xabcx", "xadcx"), ("é日本", "é日x本"), ("ab", "ba"),
             ("q" * 3000 + "r", "q" * 2999 + "sr")]
    rows = spark.createDataFrame(pairs, "x string, y string").withColumn("n", F.levenshtein("x", "y"))
    got = rows.select("n", F.expr(f"{simline._trimmed('x', 'y')}[0]").alias("s")).select("n", "s.*").withColumn("m", F.levenshtein("x", "y")).collect()
    assert all(r["n"] == r["m"] for r in got) and max(len(r["x"]) for r in got) <= 2


@pytest.mark.parametrize("bucket", [64, 3])
def test_lines_equal_brute_force(spark, bucket, monkeypatch):
    monkeypatch.setattr("tessel.llm.simline.BUCKET", bucket)
    rng = random.Random(4)
    rows = []
    for size, copies, changed in ((80, 40, 2), (12, 60, 2), (12, 60, 6)):
        base = [f"v{rng.randrange(5000)}" for _ in range(size)]
        for _ in range(copies):
            line = list(base)
            for _ in range(rng.randrange(changed + 1)):
                line[rng.randrange(size)] = f"u{rng.randrange(99)}"
            rows.append((len(rows), " ".join(line)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sims = {r["doc"]: r["sim"] for r in simline.fingerprints(simline.lines(docs, "doc_id", "text")).collect()}
    text = dict(rows)
    links = [(a, b) for a in text for b in text if a < b and linked(sims[a], sims[b], text[a], text[b])]
    root = {i: i for i in text}
    while True:
        before = dict(root)
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
        if root == before:
            break
    gone = {r["doc"] for r in simline.removed_lines(docs).collect() if r["removed"]}
    assert gone == {i for i in root if root[i] != i}
    assert any(bin((sims[a] ^ sims[b]) & (2**64 - 1)).count("1") > 3 for a, b in links)


def test_line_links_grow_with_the_lines(spark, monkeypatch):
    """A class of near lines costs no more comparisons than its lines have block pairs, not all its pairs."""
    rng, compared, close = random.Random(7), [], simline._close
    base = [f"v{rng.randrange(5000)}" for _ in range(80)]
    rows = [(i, " ".join(base[:j] + [f"u{i}"] + base[j + 1:])) for i, j in enumerate(rng.randrange(80) for _ in range(60))]

    def counted(pairs, *rest):
        compared.append(pairs.dropDuplicates(["x", "y"]).count())
        return close(pairs, *rest)

    monkeypatch.setattr(simline, "_close", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sum(len(r["removed"]) for r in simline.removed_lines(docs).collect()) > 40
    assert 0 < sum(compared) <= 10 * len(rows)


def test_fingerprint_is_the_majority_of_word_hashes(spark):
    """Lanes of 8 and of 16 bits, odd and even numbers of words."""
    rows = [(n, " ".join(f"w{n}x{i}" for i in range(n))) for n in (1, 2, 7, 8, 126, 127, 128, 300, 511)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc"]: r["sim"] for r in simline.fingerprints(simline.lines(docs, "doc_id", "text")).collect()}
    hashed = docs.select("doc_id", F.explode(F.split("text", " ")).alias("w")).select("doc_id", F.xxhash64("w", F.lit(0)).alias("h")).collect()
    for n, _ in rows:
        hs = [r["h"] for r in hashed if r["doc_id"] == n]
        votes = [2 * sum(h >> i & 1 for h in hs) + (min(hs) >> i & 1) for i in range(64)]
        want = sum(1 << i for i in range(64) if votes[i] > n)
        assert got[n] & (2**64 - 1) == want


@pytest.mark.parametrize("x, y, alike", [
    ("abcde " * 9 + "abcde", "abcde " * 9 + "abcdx", True),  # one short stretch
    (" ".join(["same"] * 30 + ["one"]), " ".join(["sane"] * 30 + ["two"]), False),  # too far word by word: the distance decides
    ("ab cd ef gh ij kl mn op qr st uv", "cd ef gh ij kl mn op qr st uv ab", True),  # same words moved: far place by place, near as texts
])
def test_bounds_agree_with_the_distance(spark, x, y, alike):
    most = int(0.2 * max(len(x), len(y)))
    row = spark.createDataFrame([(x, y, most)], "x string, y string, most int")
    sure = row.select(F.expr(f"exists({simline._trimmed('x', 'y')}, s -> case {simline.SURE} else false end)").alias("sure"), F.levenshtein("x", "y").alias("d")).first()
    assert (sure["d"] <= most) == alike and (alike or not sure["sure"])


def test_license_scan_edges(spark, edge, empty):
    got = {r["doc_id"]: r for r in setscan.scan(edge).collect()}
    assert (got[9]["n_base"], got[9]["first_word"], got[9]["base_labels"], got[9]["score"]) == (1, 3, "mit", 1.0)
    assert (got[0]["n_words"], got[0]["labels"], got[0]["first_word"]) == (0, "", None)
    assert setscan.scan(edge).count() == 12 and setscan.scan(empty).count() == 0


def test_license_templates_across_line_ends(spark):
    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy\n"
           "of this software and associated documentation files")
    bsd = "Redistribution and use in source and binary forms, with or without\n\nmodification, are permitted provided that"
    pad = " ".join(f"x{i}" for i in range(45))
    rows = [(1, mit), (1, bsd), (None, f"{pad}\n{mit}"), (2, "of this software to any person " + pad + " permission is hereby granted free"), (3, bsd), (3, bsd)]
    rows += [(10 + i, " ".join(f"y{k}" for k in range(i)) + "\n" + mit) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = collections.Counter((r["doc_id"], r["labels"]) for r in setscan.scan(docs).collect())
    want = {(1, "mit-text"): 1, (1, "bsd-text"): 1, (None, "mit-text"): 1, (2, ""): 1, (3, "bsd-text"): 2}
    assert got == want | {(10 + i, "mit-text"): 1 for i in range(40)}
    assert {r["labels"] for r in setscan.scan(docs, templates={}).collect()} == {""}


@pytest.mark.parametrize("seed", [1, 2])
def test_license_blocks_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    known = sorted({w for t in setscan.TEMPLATES for w in t.split()})
    texts = []
    for _ in range(120):
        template = rng.choice(list(setscan.TEMPLATES)).split()
        held = [w for w in template if rng.random() > 0.08]
        texts.append(rng.choice([" ", "\n", " - "]).join(rng.choices(known, k=rng.randrange(60)) + held + rng.choices(known, k=rng.randrange(60))))
    step = max(len(t.split()) for t in setscan.TEMPLATES)
    want = {}
    for i, text in enumerate(texts):
        w = re.findall("[0-9a-z]+", text)
        blocks = [set(w[s:s + 2 * step]) for s in range(0, len(w), step)]
        parts = {label: max((len(b & set(t.split())) / len(set(t.split())) for b in blocks), default=0) for t, label in setscan.TEMPLATES.items()}
        want[i] = {label for label, part in parts.items() if part >= setscan.CONTAINMENT - 1e-9}
    got = setscan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    base = set(setscan.PHRASES.values())
    assert {r["doc_id"]: set(r["labels"].split(",")) - {""} - base for r in got} == want and any(want.values())


def reference_spans(text):
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                "card": r"[0-9]([ -]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    out = []
    for order, (kind, pattern) in enumerate(patterns.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub(r"\D", "", m.group())
            if (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m.group().split("."))
                    or kind == "card" and 14 <= len(digits) <= 19 and pii._luhn(digits) or kind == "phone" and 10 <= len(digits) <= 15):
                out.append((m.start(), order, m.end(), kind))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def test_personal_data(spark, edge, empty):
    rng = random.Random(3)
    parts = ["1", "2", "4", "9", "255", ".", ".", "-", " ", "+", "@", "a", "(", ")", "b.c", "@x.y", "x", "é"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 40)))
        assert ",".join(f"{k}:{a}:{b}" for a, b, k in pii.base_spans(text)) == reference_spans(text)
    rows = [(i, f"mail a{i}@b.org now") for i in range(9)] + [(9, "mail user77at now and mail a9x@c.de now")]
    got = {r["doc_id"]: r for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[9]["base"] == "email:27:35" and "email:27:35" in got[9]["spans"]
    assert got[9]["base_sha256"] == hashlib.sha256(b"email:27:35").hexdigest()
    assert pii.find(edge).count() == 12 and pii.find(empty).count() == 0


def test_unseen_identifiers_in_recurring_contexts(spark):
    rows = [(i, f"mail a{i}@b.org now") for i in range(30)] + [(100 + i, f"call +1 555 010 {i:04d} today") for i in range(30)]
    unseen = ["mail user77at now", "mail bob at x.org now", "mail bob@localhost now", "call 555-123-4567 today", "call (555) 123-9876 today",
              "call 00 49 30 1234567 today", "see (555) 123-9876 there", "see user99at there"]
    rows += [(200 + i, t) for i, t in enumerate(unseen)]
    got = {r["doc_id"]: r["spans"] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] == "email:5:13" and got[100] == "phone:5:20"
    want = [("email", "user77at"), ("email", "bob at x.org"), ("email", "bob@localhost"), ("phone", "555-123-4567"), ("phone", "(555) 123-9876"),
            ("phone", "00 49 30 1234567")]
    assert [got[200 + i] for i in range(8)] == [f"like_{k}:5:{5 + len(w)}" for k, w in want] + ["", ""]


def test_toxicity(spark, edge, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    got = {r["doc_id"]: r for r in q.QUERIES["op7_boosted_toxicity"](spark, "/root/testdata/sf0.01").collect()}
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got.values())
    held = [(got[d]["score"], y) for d, y in labels.items() if got[d]["held_out"]]
    pos, neg = [s for s, y in held if y], [s for s, y in held if not y]
    assert sum((a > b) + (a == b) / 2 for a in pos for b in neg) / len(pos) / len(neg) > 0.8
    model = ToxicityModel.fit(empty.withColumn("toxic", F.lit(1)), "doc_id", "text", "toxic")
    assert {r["s"] for r in model.score(edge.select("doc_id", "text"), "text", "s").collect()} == {0.0}


def test_suffix_tree(spark, edge, empty):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    tokens = {d: words(t) + ["\n"] for d, t in rows}
    held = {d: zlib.crc32(str(d).encode()) % 10 == 0 for d in tokens}
    count = collections.Counter(w for d, ws in tokens.items() if not held[d] for w in ws)
    total, kinds = sum(count.values()), len(count)
    gain = 0.0
    for r in q.QUERIES["op1_suffix_tree"](spark, "/root/testdata/sf0.01").collect():
        mine = tokens[r["doc_id"]]
        base = sum(math.log10((count[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in mine)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[r["doc_id"]], len(mine), sum(w in count for w in mine), total)
        assert r["base_score"] == pytest.approx(base)
        gain += (r["score"] - r["base_score"]) * r["held_out"]
    assert gain > 0
    got = score_texts(edge, F.lit(False)).collect()
    assert len(got) == 12 and all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)
    assert score_texts(empty, F.lit(False)).count() == 0
    assert all(math.isfinite(r["score"]) for r in score_texts(edge, F.lit(True)).collect())


def test_pipeline(spark, empty):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scratch, steps = Scratch(spark, "test"), [docs]
    for name, stage in corpus_pipeline.STAGES:
        steps.append(scratch.put(stage(spark, steps[-1], SF)))
        assert steps[-1].columns[:5] == docs.columns and (name == "bpe" or steps[-1].columns == docs.columns)
    ids = [{r["doc_id"] for r in s.select("doc_id").collect()} for s in steps]
    assert all(after <= before for before, after in zip(ids, ids[1:])) and ids[5] == ids[4]
    rows = [tuple(r) for r in steps[2].select("doc_id", "text").collect()]
    assert ids[3] == {d for d, (_, root) in brute_classes(rows, 80).items() if d == root}
    found = {r["doc_id"] for r in find_passages(steps[3], spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert ids[4] == ids[3] - found
    assert steps[5].filter("decoded <> text").count() == 0
    none = empty.select(docs.columns)
    for _, stage in corpus_pipeline.STAGES:
        none = scratch.put(stage(spark, none, SF)).select(docs.columns)
    assert none.count() == 0
