"""The operators applied to whole test tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perennial.llm import (
    collocations,
    embedding_dedup,
    kneser_ney,
    ngram_bloom,
    odd_sketch,
    order_minhash,
    pareto_mix,
    quote_threads,
    stratified_shards,
    token_alignment,
    token_packing,
    url_reputation,
    variable_bins,
)
from perennial.llm.shared import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run):
    QUERIES[run.__name__] = run
    return run


@query
def op1_itq_dedup(spark, sf_dir):
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op2_bloom_lm(spark, sf_dir):
    documents = ngram_bloom.with_held_out(table(spark, sf_dir, "documents"))
    return ngram_bloom.score_texts(documents)


@query
def op3_order_minhash(spark, sf_dir):
    return order_minhash.fingerprints(table(spark, sf_dir, "documents"))


@query
def op4_token_packing(spark, sf_dir):
    return token_packing.packed_sequences(table(spark, sf_dir, "documents"))


@query
def op5_pareto_mix(spark, sf_dir):
    mix = pareto_mix.with_copies(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    taken = (F.col("size") * F.col("copies")).cast("long").alias("taken")
    return mix.select("row.doc_id", "size", "source_size", "target", taken)


@query
def op6_kneser_ney(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    trusted = kneser_ney.trusted_ids(table(spark, sf_dir, "labels"))
    return kneser_ney.judged(documents, trusted, carried=("doc_id", "lang")).select(
        "row.doc_id", "row.lang", F.col("quality_words").alias("n_words"), "perplexity", "threshold",
        F.col("keep").alias("kept"),
    )


@query
def op7_odd_sketch(spark, sf_dir):
    return odd_sketch.near_duplicates(table(spark, sf_dir, "documents"), odd_sketch.Rule(shingle=4))


@query
def op8_url_reputation(spark, sf_dir):
    """Labels are outcomes of the page of the same number: good means high quality, not toxic."""
    labels = table(spark, sf_dir, "labels")
    good = ((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).cast("int")
    outcomes = labels.select(F.col("doc_id").alias("page_id"), good.alias("good"))
    return url_reputation.judged_urls(table(spark, sf_dir, "pages"), outcomes)


@query
def op9_variable_bins(spark, sf_dir):
    return variable_bins.packed_documents(table(spark, sf_dir, "documents"))


@query
def op10_quote_threads(spark, sf_dir):
    return quote_threads.chat_messages(table(spark, sf_dir, "conversations"))


@query
def op11_token_alignment(spark, sf_dir):
    return token_alignment.alignment_digests(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op12_stratified_shards(spark, sf_dir):
    return stratified_shards.shard_digests(table(spark, sf_dir, "documents"))


@query
def op13_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents").select("text", "lang"))
