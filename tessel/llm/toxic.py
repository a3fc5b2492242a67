"""Toxicity from dense features: boosted trees with isotonic calibration."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, functions as F

from tessel.llm.scratch import Scratch
from tessel.llm.text import BASE, BYTE, INVERSE, Words, chunks, mix, powers

#: Lexicon entries, words and stems each; the highest log odds win.
LEXICON = 400
#: An entry occurs in this many toxic training texts at least.
SUPPORT = 5
#: Rows the trees and the calibration are fitted on, at most, drawn by hash of the key.
FIT_ROWS = 30_000
#: Bytes of a stem.
STEM = 5
#: Words between a second-person word and a lexicon entry that count as near.
NEAR = 5
#: Second-person words of English, German, French and Spanish.
SECOND = ("you", "your", "yours", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr", "euch", "tu", "te", "toi", "ton", "ta",
          "vous", "votre", "usted", "ustedes", "ti", "contigo")
#: Columns of features, named so that none of a table of texts is likely to clash.
FEATURES = tuple("__toxic_" + name for name in (
    "words", "lexicon", "lexicon_share", "stems", "stem_share", "strength", "near_second", "second_share", "capital_share",
    "shout_share", "marks", "exclaims", "obfuscated", "repeats"))
_STRIP = np.zeros(256, bool)
_STRIP[[ord(c) for c in ".,;:!?\"'()[]{}<>-_*"]] = True


def _bare(words):
    """Bounds of words without marks at their ends."""
    start, end = words.start.copy(), words.end.copy()
    for _ in range(3):
        cut = (end - start > 1) & _STRIP[words.data[np.minimum(start, len(words.data) - 1)]] if len(start) else np.zeros(0, bool)
        start[cut] += 1
        cut = (end - start > 1) & _STRIP[words.data[end - 1]] if len(end) else np.zeros(0, bool)
        end[cut] -= 1
    return start, end


def _codes(words, start, end):
    total = np.zeros(len(words.data) + 1, np.uint64)
    np.cumsum(BYTE[words.data] * powers(BASE, len(words.data)), out=total[1:])
    return mix((total[end] - total[start]) * powers(INVERSE, len(words.data) + 1)[start])


def _entries(words):
    """Codes of bare words and of their stems (0 for shorter words)."""
    start, end = _bare(words)
    word = _codes(words, start, end)
    stem = np.where(end - start > STEM, _codes(words, start, np.minimum(start + STEM, end)) ^ np.uint64(1), np.uint64(0))
    return word, stem, start, end


def code(word: str) -> int:
    """Code of one word, as in ``_entries``."""
    raw = np.frombuffer(word.encode(), np.uint8)
    return int(Words(raw, np.array([0, len(raw)])).code[0])


def _present(batches):
    """``(entry, toxic, n)``: training texts of each label that hold an entry, summed over a batch."""
    for batch in batches:
        toxic = batch.column(1).to_numpy(zero_copy_only=False)
        for row, words in chunks(batch.column(0)):
            word, stem, _, _ = _entries(words)
            doc = np.repeat(np.arange(len(words.off) - 1), np.diff(words.off))
            code_ = np.concatenate([word, stem])
            pair = np.unique(np.stack([code_, np.concatenate([doc, doc]).astype(np.uint64)]), axis=1)
            for label in (0, 1):
                e, n = np.unique(pair[0][toxic[row + pair[1].astype(np.int64)] == label], return_counts=True)
                yield pa.RecordBatch.from_pydict({"entry": e.view(np.int64), "toxic": np.full(len(e), label, np.int32), "n": n.astype(np.int64)})


def _featurize(lexicon: dict[int, float]):
    entries = np.array(sorted(lexicon), np.int64).view(np.uint64)
    entries.sort()
    weight = np.array([lexicon[int(e)] for e in entries.view(np.int64)])
    second = np.array(sorted(code(w) for w in SECOND), np.uint64)

    def known(table, codes):
        if not len(table):
            return np.zeros(len(codes), bool), np.zeros(len(codes), np.int64)
        at = np.minimum(np.searchsorted(table, codes), len(table) - 1)
        return table[at] == codes, at

    def run(batches):
        for batch in batches:
            for row, words in chunks(batch.column(batch.num_columns - 1)):
                n = len(words.off) - 1
                word, stem, start, end = _entries(words)
                hit, at = known(entries, word)
                hit_stem, at_stem = known(entries, stem)
                you, _ = known(second, word)
                data = words.data

                def per_doc(x):
                    total = np.concatenate([[0], np.cumsum(x)])
                    return total[words.off[1:]] - total[words.off[:-1]]

                def inside(mask):  # marked bytes of every word
                    total = np.concatenate([[0], np.cumsum(mask)])
                    return total[end] - total[start]

                upper, letter = (data >= 65) & (data <= 90), ((data | 32) >= 97) & ((data | 32) <= 122) | (data >= 128)
                digit = (data >= 48) & (data <= 57)
                odd = digit | np.isin(data, np.frombuffer(b"*@$#|", np.uint8))
                size = end - start
                shout = (inside(upper) == size) & (size > 1)
                mixed = (inside(letter) > 0) & (inside(odd) > 0) & (inside(letter) + inside(odd) == size)
                again = np.zeros(len(data), bool)
                again[2:] = (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & letter[2:]
                mark = np.zeros(len(word) + 1, np.int64)
                np.cumsum(you, out=mark[1:])
                doc = np.repeat(np.arange(n), np.diff(words.off))
                low = np.maximum(np.arange(len(word)) - NEAR, words.off[:-1][doc])
                high = np.minimum(np.arange(len(word)) + NEAR + 1, words.off[1:][doc])
                near = hit & (mark[high] - mark[low] > 0)
                total = np.maximum(np.diff(words.off), 1)
                bytes_ = np.maximum(np.diff(words.bounds), 1)

                def per_text(mask):
                    sums = np.concatenate([[0], np.cumsum(mask)])
                    return sums[words.bounds[1:]] - sums[words.bounds[:-1]]

                strength = per_doc(np.where(hit, weight[at] if len(weight) else 0, 0) + np.where(hit_stem, weight[at_stem] if len(weight) else 0, 0))
                x = [np.diff(words.off), per_doc(hit), per_doc(hit) / total, per_doc(hit_stem), per_doc(hit_stem) / total, strength / np.sqrt(total),
                     per_doc(near), per_doc(you) / total, per_text(upper) / np.maximum(per_text(letter), 1), per_doc(shout) / total,
                     per_text(_STRIP[data]) / bytes_, per_text(data == 33) / bytes_, per_doc(mixed) / total, per_text(again) / bytes_]
                kept = batch.slice(row, n)
                yield pa.RecordBatch.from_arrays([*kept.columns[:-1], *[pa.array(np.asarray(v, np.float64)) for v in x]],
                                                 names=[*batch.schema.names[:-1], *FEATURES])
    return run


def features(docs: DataFrame, lexicon: dict[int, float], text: str) -> DataFrame:
    """``docs`` with one double column for each of FEATURES instead of ``text`` (null: empty)."""
    rest = [c for c in docs.columns if c != text and c not in FEATURES]
    held = docs.select(*[F.col(f"`{c}`") for c in rest], F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("__text"))
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in held.schema[:-1]], *[f"{f} double" for f in FEATURES]])
    return held.mapInArrow(_featurize(lexicon), schema)


class ToxicityModel:
    """Lexicon, trees and calibration. ``score`` adds a column with the calibrated probability to any table of texts."""

    def __init__(self, lexicon, trees, steps):
        self.lexicon, self.trees, self.steps = lexicon, trees, steps

    @classmethod
    def fit(cls, labelled: DataFrame, key: str, text: str, label: str, seed: int = 7) -> "ToxicityModel":
        """Learn from rows ``(key, text, label 0/1)``; null labels are left out.

        Lexicon: all rows count; entries are words and stems with the highest log odds. Trees: four fifths of
        at most FIT_ROWS rows by hash of the key; calibration: the other fifth. Where the four fifths lack a
        class, or the other fifth is empty, both take all of those rows. With one class only (or none) the
        score is the share of toxic rows, for every text.
        """
        scratch = Scratch(labelled.sparkSession, "toxic")
        rows = labelled.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").cast("string").alias("t"), F.col(f"`{label}`").cast("int").alias("y")).filter("y in (0, 1)")
        n, toxic = rows.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
        if toxic == 0 or toxic == n:
            return cls({}, None, toxic / n if n else 0.0)
        seen = rows.select("t", "y").mapInArrow(_present, "entry long, toxic int, n long").filter("entry <> 0")
        seen = seen.groupBy("entry").agg(F.sum(F.col("n") * F.col("toxic")).alias("a"), F.sum(F.col("n") * (1 - F.col("toxic"))).alias("b"))
        odds = F.log((F.col("a") + 0.5) / (toxic + 1)) - F.log((F.col("b") + 0.5) / (n - toxic + 1))
        best = seen.filter(F.col("a") >= SUPPORT).select("entry", odds.alias("w")).filter("w > 1").orderBy(F.desc("w"), "entry").limit(LEXICON)
        lexicon = {r[0]: r[1] for r in best.collect()}
        share = min(1.0, FIT_ROWS / n)
        some = rows.filter(F.expr(f"pmod(xxhash64(id, {seed}), 1000000)") < share * 1_000_000)
        table = scratch.put(features(some, lexicon, "t"))
        hold = F.expr(f"pmod(xxhash64(id, {seed + 1}), 5)") == 0
        sides = {(r[0], r[1]) for r in table.select(hold, "y").distinct().collect()}
        if not {(False, 0), (False, 1)} <= sides or not any(h for h, _ in sides):
            if {y for _, y in sides} != {0, 1}:
                return cls({}, None, toxic / n)
            fit_rows = margin_rows = F.lit(True)
        else:
            fit_rows, margin_rows = ~hold, hold
        table = VectorAssembler(inputCols=list(FEATURES), outputCol="features", handleInvalid="keep").transform(table)
        trees = GBTClassifier(labelCol="y", maxIter=15, maxDepth=3, stepSize=0.3, seed=seed, maxBins=64).fit(table.filter(fit_rows))
        raw = vector_to_array("rawPrediction")[0] * -1
        margin = trees.transform(table.filter(margin_rows)).select(F.col("y").cast("double").alias("y"), raw.alias("x"))
        steps = IsotonicRegression(labelCol="y", featuresCol="x").fit(margin)
        return cls(lexicon, trees, steps)

    def score(self, docs: DataFrame, text: str, out: str) -> DataFrame:
        """``docs`` without ``text``, with ``out``: the calibrated score, which rises slightly with the margin inside a step."""
        got = features(docs, self.lexicon, text)
        if self.trees is None:
            return got.drop(*FEATURES).withColumn(out, F.lit(float(self.steps)))
        got = VectorAssembler(inputCols=list(FEATURES), outputCol="__features").transform(got)
        trees = self.trees.copy().setFeaturesCol("__features").setRawPredictionCol("__raw").setProbabilityCol("__p").setPredictionCol("__y")
        got = trees.transform(got).withColumn("__m", vector_to_array("__raw")[0] * -1)
        got = self.steps.copy().setFeaturesCol("__m").setPredictionCol("__c").transform(got)
        calibrated = F.col("__c")
        # equal steps keep the order of margins: a hundredth of the score follows the logistic of the margin
        mixed = 0.99 * calibrated + 0.01 / (1 + F.exp(-2 * F.col("__m")))
        return got.withColumn(out, mixed).drop(*FEATURES, "__features", "__raw", "__p", "__y", "__m", "__c")
