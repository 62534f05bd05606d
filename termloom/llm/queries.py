"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm import decontaminate, divergence, embedding_forest, filter_audit, language, ngram_jaccard, packing, secrets, suffix_merge, surrogates, urls, warc, weak_quality


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    """The default tokenizer file, where the public vocabularies are installed."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: Key of the registered query; a deployment passes its own.
PII_KEY = "registered-query"


def op1_surrogates(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.pseudonymise(docs, PII_KEY).select("doc_id", "text", F.col("n_entities_").cast("bigint").alias("n_entities"))


def op2_decontaminate(spark, sf_dir):
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


# Fixed values of the query: host, path, verdict.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op3_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    rules = spark.createDataFrame(URL_RULES, "rule_host string, rule_path string, verdict string")
    return urls.judge(pages, rules, urls.declared_edges(pages))


def op4_secrets(spark, sf_dir):
    found = secrets.scan(table(spark, sf_dir, "documents"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE))
    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, secrets.BASE), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op5_embedding_forest(spark, sf_dir):
    return embedding_forest.link_vectors(table(spark, sf_dir, "embeddings"))


def op6_weak_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = weak_quality.with_score(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", F.round("quality_score_", 6).alias("score"), (F.col("quality_score_") >= 0.5).alias("keep"))


def op7_packing(spark, sf_dir, tokenizer=None):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer or vocabulary())


def op8_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, docs.filter(~language.held_out(F.col("doc_id"))))


def op9_suffix_merge(spark, sf_dir):
    return suffix_merge.remove_repeats(table(spark, sf_dir, "documents"))


def op10_ngram_jaccard(spark, sf_dir):
    return ngram_jaccard.jaccard_join(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark, sf_dir):
    return filter_audit.audit_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_warc_salvage(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op13_divergence(spark, sf_dir):
    return divergence.divergence(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_surrogates,
        op2_decontaminate,
        op3_url_filter,
        op4_secrets,
        op5_embedding_forest,
        op6_weak_quality,
        op7_packing,
        op8_language,
        op9_suffix_merge,
        op10_ngram_jaccard,
        op11_filter_audit,
        op12_warc_salvage,
        op13_divergence,
    )
}

