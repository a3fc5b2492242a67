import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessel.llm.alignment import FAN, Fragment, align

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = bytes([*range(33, 127), *range(161, 173), *range(174, 256)])


def tokens():
    shown = {chr(b): b for b in ALPHABET}
    for b in range(256):
        if b not in ALPHABET:
            shown[chr(256 + len(shown) - len(ALPHABET))] = b
    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=B)

    def spell(i):
        p = second.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()

    def both(text):
        a = first.encode(" " + text, add_special_tokens=False).ids
        return ([(i, bytes(shown[c] for c in first.id_to_token(i))) for i in a], [(i, spell(i)) for i in second.encode(text)])
    return both


def brute(rows):
    """Whole texts through the libraries, byte ranges compared pair by pair."""
    both, held, docs = tokens(), [], Counter()
    for doc, text in rows:
        a, b = both(text) if text else ([], [])
        want = (" " + (text or "")).encode()
        if b"".join(t for _, t in a) != want or b"".join(t for _, t in b) != want or not text:
            a, b = [], []
        ends = [np.cumsum([0] + [len(t) for _, t in x]).tolist() for x in (a, b)]
        linked, j = [], 0
        for i in range(len(a)):
            while j and ends[1][j] > ends[0][i]:
                j -= 1
            k = j
            while k < len(b) and ends[1][k] < ends[0][i + 1]:
                if ends[1][k + 1] > ends[0][i]:
                    linked.append((a[i][0], b[k][0]))
                k += 1
            j = max(k - 1, 0)
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups = []
        for x, y in zip(cuts, cuts[1:]):
            groups.append(",".join(str(t[0]) for t, e in zip(a, ends[0][1:]) if x < e <= y) + "|" + ",".join(str(t[0]) for t, e in zip(b, ends[1][1:]) if x < e <= y))
        held.append((doc, len(a), len(b), groups, linked))
        docs.update(set(linked))
    most = Counter()
    for (a, _), n in docs.items():
        most[a] = max(most[a], n)
    return sorted((str(doc), n_a, n_b, len(g), len(l), sum(docs[p] == most[p[0]] for p in l), sum(docs[p] for p in l),
                   hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for doc, n_a, n_b, g, l in held)


def rows_of(df):
    return sorted((str(r[0]), *r[1:]) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect())


def hard_texts():
    rng = random.Random(2)
    bits = ["word", " ", "  ", "\n", "\n\n", "\t", "Étion", "naïve", "漢字かな", "🙂", " ", " ", "　", "<|endoftext|>", "</s>", "<0x41>", "it's", "'re", "1234567", "\r\n", "\x00",
            "\x1f", "«x»", "é", "--", "antidisestablishment", "ß", ".", "don't ", "​", "\u0085"]
    made = ["".join(rng.choices(bits, k=rng.randint(1, 25))) for _ in range(150)]
    return made + [None, "", " ", "\n", "\n a", " a", "a ", "  a  b  ", "▁", "a▁b", "same text here", "same text here", "x" * 300, "あ" * 90, "\nfoo\nbar baz\n", " \n x"]


@pytest.mark.parametrize("span,send", [(1 << 16, 1 << 20), (40, 1 << 20), (7, 25)])
def test_equal_to_libraries_on_whole_texts(spark, span, send):
    rows = [(i, t) for i, t in enumerate(hard_texts())] + [(3, "again"), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("pair", F.lit(1)).withColumn("row", F.lit("x")).withColumn("n_a", F.lit(0))
    assert rows_of(align(docs.repartition(3), A, B, span=span, send=send)) == brute(rows)


def test_long_document_over_several_rounds(spark):
    rng = random.Random(9)
    text = "".join(rng.choice(["the ", "cat\n", "épée ", "sat-on ", "mat. ", "漢字", "  "]) for _ in range(6000))
    assert len(text.encode()) // 64 > FAN ** 2
    rows = [(1, text), (2, "the cat"), (3, text[:500] + "▁" + text[500:3000])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(align(docs, A, B, span=64)) == brute(rows)


def test_composition_is_associative():
    rng = np.random.default_rng(1)
    for _ in range(60):
        ends = [np.append(np.sort(rng.choice(np.arange(1, 200), rng.integers(5, 90), replace=False)), 200) for _ in range(2)]
        ids = [rng.integers(0, 50, len(e)) for e in ends]
        cut = [0, *np.sort(rng.choice(np.arange(1, 200), 6, replace=False)).tolist(), 200]

        def part(low, high):
            keep = [(e > low) & (e <= high) for e in ends]
            return Fragment.of(ids[0][keep[0]], ends[0][keep[0]], ids[1][keep[1]], ends[1][keep[1]])

        parts = [part(a, b) for a, b in zip(cut, cut[1:])]
        left = parts[0]
        for p in parts[1:]:
            left = left.then(p)
        tree = parts
        while len(tree) > 1:
            tree = [tree[i].then(tree[i + 1]) if i + 1 < len(tree) else tree[i] for i in range(0, len(tree), 2)]
        for a, b in ((left, tree[0]), (left, part(0, 200))):
            assert a.closed == b.closed and a.n_groups == b.n_groups and (a.n_a, a.n_b) == (b.n_a, b.n_b)
            assert a.pairs.tolist() == b.pairs.tolist() and a.times.tolist() == b.times.tolist()
            assert [x.tolist() for x in (*a._pre(), *a._suf())] == [x.tolist() for x in (*b._pre(), *b._suf())]


def test_empty_table(spark):
    assert align(spark.createDataFrame([], "doc_id long, text string"), A, B).count() == 0
