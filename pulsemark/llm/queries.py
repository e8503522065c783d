"""The operators' queries by name: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import caps, contamination, language, lm, minhash, mixing, pieces, pii, prefixes, quality, suffixes, toxicity, whitening
from .columns import fold, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


@query("op9_toxicity")
def op9_toxicity(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    learned = docs.where(fold("doc_id", 5) != 0)
    model = toxicity.fit(learned, table(spark, folder, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


@query("op3_pii")
def op3_pii(spark, folder):
    return pii.digest(table(spark, folder, "documents"))


@query("op8_mixing")
def op8_mixing(spark, folder):
    taken = mixing.mix(table(spark, folder, "documents"))
    return taken.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query("op6_minhash")
def op6_minhash(spark, folder):
    return minhash.near_duplicates(table(spark, folder, "documents"), k=3, percent=85)


@query("op7_decontamination")
def op7_decontamination(spark, folder):
    return contamination.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op10_language")
def op10_language(spark, folder):
    docs = table(spark, folder, "documents")
    model = language.fit(docs.where(fold("doc_id", 4) != 2))
    made = language.predict(docs.select("doc_id", "text"), model)
    return made.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


@query("op2_lm")
def op2_lm(spark, folder):
    docs = table(spark, folder, "documents")
    made, model = lm.fit_and_score(docs.where(fold("doc_id", 7) != 2), docs)
    return made.select("doc_id", (fold("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known",
                       F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


@query("op1_quality")
def op1_quality(spark, folder):
    """Hosts are the documents' sources, paths their language sections."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = quality.fit(docs, labels)
    made = quality.posteriors(docs, labels, model, F.col("source"), F.col("lang"))
    return made.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


@query("op5_caps")
def op5_caps(spark, folder):
    return caps.near_duplicates(table(spark, folder, "embeddings"))


@query("op4_suffixes")
def op4_suffixes(spark, folder):
    return suffixes.trim(table(spark, folder, "documents"))


@query("op13_whitening")
def op13_whitening(spark, folder):
    return whitening.whiten(table(spark, folder, "embeddings"))


PREFIXES_SQL = """
WITH RECURSIVE turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, strlen(coalesce(text, '')) AS size,
    md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id, turn
  FROM conversations WHERE conv_id IS NOT NULL
), ordered AS (
  SELECT c, list({'role': role, 'text': text, 'size': size} ORDER BY turn NULLS FIRST, id, size) AS own FROM turns GROUP BY c
), bits(n, k, v) AS (
  SELECT i, 0, i FROM range(256) AS r(i)
  UNION ALL
  SELECT n, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8
), crc(c, digits, k, v) AS (
  SELECT c, c::VARCHAR, 0::BIGINT, 4294967295::BIGINT FROM ordered
  UNION ALL
  SELECT c, digits, crc.k + 1, xor(crc.v >> 8, bits.v) FROM crc JOIN bits
  ON bits.k = 8 AND bits.n = xor(crc.v & 255, ascii(digits[crc.k + 1])::BIGINT) WHERE crc.k < length(digits)
), heads AS (
  SELECT c, xor(v, 4294967295) % 9 AS h FROM crc WHERE k = length(digits)
), convs AS (
  SELECT o.c, coalesce(b.own, [])[1:h] || o.own[h + 1:] AS path
  FROM ordered o JOIN heads USING (c) LEFT JOIN ordered b ON b.c = o.c - o.c % 5
), prefixes AS (
  SELECT c, d, path[1:d] AS path, path[1:d - 1] AS parent, len(path) = d AS ends
  FROM (SELECT c, path, unnest(range(len(path) + 1)) AS d FROM convs)
), nodes AS (
  SELECT path, d, any_value(parent) AS parent, min(c) AS conv_id, count(*) AS n_convs,
    coalesce((count(*) - 1) * path[d].size, 0) AS saved,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256
  FROM prefixes GROUP BY path, d
), children AS (
  SELECT parent AS path, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY parent
), known AS (
  SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (path)
), below AS (
  SELECT path[1:k] AS path, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT path, n_children, saved, unnest(range(d + 1)) AS k FROM known) GROUP BY path[1:k]
)
SELECT k.conv_id, k.d::BIGINT AS depth, p.conv_id AS parent_conv_id, k.n_convs, k.n_children, n_leaves,
  saved_tokens::BIGINT AS saved_tokens, k.ends_sha256
FROM known k JOIN below USING (path) LEFT JOIN nodes p ON k.d > 0 AND p.path = k.parent
"""


@query("op11_prefixes", PREFIXES_SQL)
def op11_prefixes(spark, folder):
    """Conversations rebuilt on the first turns of every fifth one, then their tree."""
    turns = prefixes.numbered(table(spark, folder, "conversations"))
    conv = F.col("conv")
    heads = F.crc32(conv.cast("string").cast("binary")) % 9
    return prefixes.tree(*prefixes.rebuilt(turns, conv - conv % 5, heads, most=8))


@query("op12_pieces")
def op12_pieces(spark, folder):
    made = pieces.encoded(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return made.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
