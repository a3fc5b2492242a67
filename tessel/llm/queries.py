"""Registered queries of the subpackage and the SQL they must agree with."""

from __future__ import annotations

import functools

import public_tokenizers

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessel.llm import bpe, pii, setscan
from tessel.llm.alignment import align
from tessel.llm.balltree import exact_topk
from tessel.llm.chosenpath import similar_classes
from tessel.llm.editcount import count_edits
from tessel.llm.phrases import collocations
from tessel.llm.replytree import chain_links, format_trees, read_back
from tessel.llm.scratch import SMALL_KEYS, reach
from tessel.llm.simline import removed_lines
from tessel.llm.simwindow import find_passages
from tessel.llm.suffixtree import score_texts
from tessel.llm.toxic import ToxicityModel

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        @functools.wraps(fn)
        def run(spark, sf_dir):
            reach(spark)
            return fn(spark, sf_dir)
        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
           FROM embeddings),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
             CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""")
def op10_exact_topk(spark, sf_dir):
    fine = "embedding is not null and not exists(embedding, x -> x is null or isnan(x) or abs(x) = double('infinity'))"
    rows = table(spark, sf_dir, "embeddings").filter(fine).select(
        F.col("vec_id").alias("id"), F.expr("transform(embedding, x -> cast(floor(256 * cast(x as double)) as double))").alias("vec"))
    return exact_topk(rows, rows.filter("id % 50 = 0"))


def training_labels(spark, sf_dir, docs):
    """Labelled documents outside the held-out quarter."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").filter("crc32(cast(doc_id as string)) % 4 <> 2")
    few = labels.limit(SMALL_KEYS + 1).count() <= SMALL_KEYS  # else the texts are shuffled
    return docs.select("doc_id", "text").join(F.broadcast(labels) if few else labels, "doc_id")


def tokenizer_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


@query()
def op5_bpe_lexicon(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = bpe.build_lexicon(docs, tokenizer_path())
    return bpe.encode(docs, tokenizer_path(), lexicon, "n_tokens long, ids_sha256 string, decoded_sha256 string",
                      bpe.digests).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query()
def op9_chosen_path(spark, sf_dir):
    return similar_classes(table(spark, sf_dir, "documents"), percent=85)


@query()
def op2_simhash_windows(spark, sf_dir):
    return find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op3_simhash_lines(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    got = removed_lines(docs)
    lost = F.array_join(F.transform("removed", lambda i: i.cast("string")), ",")
    return got.select(F.col("doc").alias("doc_id"), "n_lines", F.size("removed").cast("long").alias("n_removed"), lost.alias("removed"))


def _scan_sql() -> str:
    phrases = ", ".join(f"('{p}', '{label}')" for p, label in setscan.PHRASES.items())
    templates = ", ".join(f"({i}, '{t}', '{label}')" for i, (t, label) in enumerate(setscan.TEMPLATES.items()))
    step = setscan.stride(setscan.TEMPLATES)
    split = "list_filter(regexp_split_to_array(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"
    return f"""
WITH p(phrase, label) AS (VALUES {phrases}), t(n, template, label) AS (VALUES {templates}),
d AS (SELECT doc_id, {split.format("coalesce(text, '')")} AS w FROM documents),
hit AS (SELECT doc_id, label, unnest(list_filter(range(len(w)), lambda i: w[i + 1:i + len(string_split(phrase, ' '))] = string_split(phrase, ' '))) AS pos FROM d, p),
base AS (SELECT doc_id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM hit GROUP BY 1),
l AS (SELECT doc_id, w[s + 1:s + {2 * step}] AS w FROM (SELECT doc_id, w, unnest(range(0, len(w), {step})) AS s FROM d)),
m AS (SELECT doc_id, label, len(list_intersect(w, string_split(template, ' '))) / len(list_distinct(string_split(template, ' '))) AS part FROM l, t),
f AS (SELECT doc_id, label, max(part) AS part FROM m WHERE part >= {setscan.CONTAINMENT} - 1e-9 GROUP BY 1, 2),
every AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(part) AS part
          FROM (SELECT doc_id, label, 0.0 AS part FROM hit UNION ALL SELECT doc_id, label, part FROM f) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CAST(CASE WHEN n_base > 0 THEN 1 ELSE coalesce(part, 0) END AS DOUBLE) AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN every USING (doc_id)
"""


@query(_scan_sql())
def op4_license_scan(spark, sf_dir):
    return setscan.scan(table(spark, sf_dir, "documents"))


@query()
def op7_boosted_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = ToxicityModel.fit(training_labels(spark, sf_dir, docs), "doc_id", "text", "toxic")
    held_out = F.expr("crc32(cast(doc_id as string)) % 4") == 2
    return model.score(docs, "text", "score").select("doc_id", held_out.alias("held_out"), "score",
                                                     (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query()
def op8_bootstrapped_pii(spark, sf_dir):
    return pii.find(table(spark, sf_dir, "documents")).drop("base")


@query()
def op1_suffix_tree(spark, sf_dir):
    return score_texts(table(spark, sf_dir, "documents"), F.expr("crc32(cast(doc_id as string)) % 10") == 0)


@query()
def op6_edit_counts(spark, sf_dir):
    """Every document takes four edits made from itself: a deletion, a repeat of its first 40 characters, a
    replacement of a stretch in its middle by its source, and an appended line."""
    docs = table(spark, sf_dir, "documents").withColumn("n", F.coalesce(F.length("text"), F.lit(0)))
    edits = F.expr("""array(
        named_struct('start', n div 3, 'stop', n div 3 + 17, 'text', ''),
        named_struct('start', n div 5, 'stop', n div 5, 'text', substring(text, 1, 40)),
        named_struct('start', n div 2, 'stop', n div 2 + 25, 'text', source),
        named_struct('start', n + 100, 'stop', n + 100, 'text', concat('\\n', lang, ' ', doc_id)))""")
    return count_edits(docs.withColumn("edits", edits), tokenizer_path())


_CONTROLS = "(/?INST\\]|/?SYSTEM_PROMPT\\]|/?ROLE\\]|TEXT\\]|/?s>)"


@query(f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, length(regexp_replace(text, '([<\\[])(~*){_CONTROLS}', '\\1~\\2\\3', 'g')) AS n_text,
             length(regexp_replace(role, '([<\\[])(~*){_CONTROLS}', '\\1~\\2\\3', 'g')) AS n_role FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
       CAST(3 + sum(n_text + CASE role WHEN 'user' THEN 15 WHEN 'system' THEN 33 WHEN 'assistant' THEN 5 ELSE 19 + n_role END) AS BIGINT)
         AS formatted_chars
FROM e GROUP BY conv_id
""")
def op11_reply_trees(spark, sf_dir):
    said = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(
        spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"))
    made = read_back(format_trees(rows, chain_links(rows, "conv_id", "turn"), "conv_id", "turn", "role", "text"))
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return made.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
                       F.length("trained").cast("long").alias("loss_chars"), F.sha2("trained", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


@query("""
WITH p AS (SELECT coalesce(lang, 'und') AS lang,
                  unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                               '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM p),
g AS (SELECT lang, unnest(flatten(list_transform(range(1, 6), lambda k: list_transform(range(0, greatest(len(w) - k + 1, 0)), lambda i: w[i + 1:i + k])))) AS ph FROM w),
f AS (SELECT lang, ph, len(ph) AS m, count(*) AS f FROM g GROUP BY 1, 2 HAVING count(*) >= 100),
t AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY 1),
longer AS (SELECT lang, ph[1:m - 1] AS ph, f FROM f WHERE m > 2 UNION SELECT lang, ph[2:m] AS ph, f FROM f WHERE m > 2),
c AS (SELECT lang, ph, m, f FROM f WHERE m > 1 AND NOT EXISTS (SELECT 1 FROM longer x WHERE x.lang = f.lang AND x.ph = f.ph AND x.f >= f.f)),
k AS (SELECT lang, ph, m, f, unnest(range(1, m)) AS k FROM c),
s AS (SELECT k.lang, k.ph, k.f AS a, k.k, l.f AS l, r.f AS r, t.n, (1000::HUGEINT * k.f * t.n) // (l.f::HUGEINT * r.f) AS score
      FROM k JOIN f l ON l.lang = k.lang AND l.ph = k.ph[1:k.k] JOIN f r ON r.lang = k.lang AND r.ph = k.ph[k.k + 1:k.m] JOIN t ON t.lang = k.lang),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, ph ORDER BY score, k) AS place FROM s),
o AS (SELECT *, array_to_string(ph, ' ') AS phrase FROM b WHERE place = 1),
z AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM o)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM z WHERE rank <= 2000
""")
def op12_phrase_collocations(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))


@query()
def op13_token_alignment(spark, sf_dir):
    return align(table(spark, sf_dir, "documents"), tokenizer_path(), public_tokenizers.path("piece_bpe_32k.model"))
