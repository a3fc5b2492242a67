"""Training-text pipeline over ``documents``: toxicity, lines, near-duplicates, benchmark passages, tokens.

Every stage but the last takes and returns the columns of ``documents``; extra columns of its input stay.
Empty input gives empty output. Null and empty texts pass all stages: they score as clean, have no lines,
link with nothing, hold no passage and have no tokens.
"""

from __future__ import annotations

import gc

from pyspark.sql import functions as F

from tessel.llm import bpe
from tessel.llm.chosenpath import similar_classes
from tessel.llm.queries import table, tokenizer_path, training_labels
from tessel.llm.scratch import Scratch, reach
from tessel.llm.simline import drop_lines
from tessel.llm.simwindow import find_passages
from tessel.llm.toxic import ToxicityModel

#: Documents with this calibrated score or more go.
TOXIC = 0.3
#: Near-duplicates: per cent of shared word shingles; benchmark passages: weighted similarity of windows.
NEAR, LEAK = 80, 0.8
# fitted trees, SimHash classes and BPE have no form in SQL: tests compare the stages with brute force
ORACLE_SQL = None


def _without(docs, gone):
    """Rows of ``docs`` whose doc_id is not in ``gone (doc_id)``; rows without a doc_id stay."""
    return docs.join(gone.select(F.col("doc_id").alias("__gone")).distinct(), F.col("doc_id") == F.col("__gone"), "left_anti")


def toxicity(spark, docs, sf_dir):
    """Fit on the labelled documents outside the held-out quarter; documents that score TOXIC or more go."""
    reach(spark)
    model = ToxicityModel.fit(training_labels(spark, sf_dir, table(spark, sf_dir, "documents")), "doc_id", "text", "toxic")
    scored = model.score(docs.withColumn("__copy", F.col("text")), "__copy", "__score")
    return scored.filter(F.col("__score") < TOXIC).select(*docs.columns)


def line_dedup(spark, docs, sf_dir):
    """Lines that repeat earlier ones go, and documents that nothing is left of."""
    reach(spark)
    return drop_lines(docs)


def near_dedup(spark, docs, sf_dir):
    """The document with the smallest doc_id of each class of near-duplicates stays."""
    reach(spark)
    gone = Scratch(spark, "near").put(similar_classes(docs, percent=NEAR).filter(~F.col("kept")).select("doc_id"))
    return _without(docs, gone)


def decontaminate(spark, docs, sf_dir):
    """Documents that hold a benchmark passage go."""
    reach(spark)
    found = Scratch(spark, "leaks").put(find_passages(docs, table(spark, sf_dir, "benchmark"), LEAK))
    return _without(docs, found)


def encode(spark, docs, sf_dir):
    """Token ids of every text, and what they decode to."""
    reach(spark)
    lexicon = bpe.build_lexicon(docs, tokenizer_path())
    return bpe.encode(docs, tokenizer_path(), lexicon, "ids array<long>, decoded string", bpe.ids_and_text)


STAGES = [("toxicity", toxicity), ("line dedup", line_dedup), ("near dedup", near_dedup), ("decontamination", decontaminate),
          ("bpe", encode)]


def run(spark, sf_dir):
    """The last stage's rows; what each stage returns is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for _, stage in STAGES[:-1]:
        docs = scratch.put(stage(spark, docs, sf_dir))
        scratch.only(docs)
        # plans of the stage are garbage now; collecting them lets Spark delete their shuffle files
        gc.collect()
        spark._jvm.System.gc()
    return STAGES[-1][1](spark, docs, sf_dir)
