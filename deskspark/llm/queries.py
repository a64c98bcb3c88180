"""The registered queries of the operators, and their expected results as SQL where SQL has them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskspark.llm import (
    contamination, expected, hard_negatives, language, ngram_join, packing, page_text, pii, quality_model, quality_rules, secret_scan, shard,
    suffix_dedup, vector_codes,
)
from deskspark.llm.common import id_fold, table

PSEUDONYM_KEY = "example-key"


def op1_page_text(spark: SparkSession, sf: str) -> DataFrame:
    return page_text.main_texts(table(spark, sf, "pages"))


def op2_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf, "documents"))


def op3_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The candidates without their values."""
    found = secret_scan.scan(table(spark, sf, "documents"))
    return found.select("doc_id", "ordinal", F.length("value").alias("n_chars"), "changes", "coverage", "score", "is_secret")


def training_labels(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "labels").filter(id_fold("doc_id", 5) != 0)


def op4_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    scored = quality_model.score_documents(docs, training_labels(spark, sf))
    return scored.select("doc_id", (id_fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op5_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = language.fit(docs.filter(id_fold("doc_id", 3) != 1))
    predicted = language.predict(docs.select("doc_id", "text"), model)
    return predicted.select("doc_id", (id_fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


def op6_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_join.link_groups(table(spark, sf, "documents"))


def op7_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return shard.shard_documents(table(spark, sf, "documents"))


def op8_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    trusted = table(spark, sf, "labels").filter("quality = 1")
    return quality_rules.judge(table(spark, sf, "documents"), trusted)


def op9_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = contamination.leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select("doc_id", "item_id", "word_start", "n_words", "n_equal")


def op10_pii_pseudonyms(spark: SparkSession, sf: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf, "documents").select("doc_id", "text"), PSEUDONYM_KEY)


def op11_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "embeddings").withColumn("label", F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"))
    return hard_negatives.mine(rows, F.col("vec_id") % 50 == 0)


def op12_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_dedup.without_repeats(table(spark, sf, "documents")).drop("kept")


def op13_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    codes, books = vector_codes.compress(table(spark, sf, "embeddings"))
    return codes.select("vec_id", "code", "error", "label_error", F.lit(vector_codes.digest(books)).alias("codebooks_sha256"))


def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)


QUERIES = {
    f.__name__: f for f in (
        op1_page_text, op2_packing, op3_secret_scan, op4_quality_classifier, op5_language_id, op6_ngram_join, op7_sharding,
        op8_quality_rules, op9_decontamination, op10_pii_pseudonyms, op11_hard_negatives, op12_suffix_dedup, op13_vector_codes, pipeline)
}

_GROUPS = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [w]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: w[i:i + 3])) END AS s FROM words),
sized AS (SELECT doc_id, len(s) AS n, s FROM sets),
kinds AS (SELECT min(doc_id) AS node, any_value(n) AS n, any_value(s) AS s FROM (SELECT *, list_sort(s) AS k FROM sized WHERE n > 0) GROUP BY k),
each AS (SELECT node, n, unnest(s) AS x FROM kinds),
pairs AS (
  SELECT a.node AS a, b.node AS b FROM each a JOIN each b ON a.x = b.x AND a.node < b.node
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
both_ways AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (SELECT a AS node, a AS r FROM both_ways UNION SELECT reach.node, both_ways.b FROM reach JOIN both_ways ON reach.r = both_ways.a),
labels AS (SELECT node, min(r) AS label FROM reach GROUP BY node)
SELECT sized.doc_id, sized.n AS n_shingles, coalesce(labels.label, kinds.node, sized.doc_id) AS component_id
FROM sized LEFT JOIN kinds ON sized.n > 0 AND list_sort(sized.s) = list_sort(kinds.s) LEFT JOIN labels ON kinds.node = labels.node
"""

ORACLE = {
    "op6_ngram_join": _GROUPS, "op11_hard_negatives": expected.NEGATIVES, "op12_suffix_dedup": expected.REPEATS, "op13_vector_codes": expected.codes(),
}
