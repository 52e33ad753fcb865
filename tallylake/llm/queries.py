"""One query per operator of the subpackage and the whole pipeline, with SQL oracles where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tallylake.llm import (
    decontamination,
    embedding_links,
    fill_in_middle,
    filter_audit,
    licenses,
    link_graph,
    mixing,
    near_duplicates,
    private_data,
    quality,
    suffix_tree,
    tokens,
    toxicity,
)
from tallylake.llm.tables import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    tree, counts = suffix_tree.train(docs)
    scores = suffix_tree.score(docs, tree, counts)
    tree.discard()
    return scores


@query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(read(spark, sf_dir, "documents"))


@query
def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


ORACLES["op5_source_mix"] = mixing.ORACLE


@query
def op8_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.measures(read(spark, sf_dir, "documents"))


ORACLES["op8_line_quality"] = quality.ORACLE


@query
def op10_toxic_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


@query
def op3_benchmark_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    )


@query
def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.grouped(read(spark, sf_dir, "documents"))


@query
def op9_link_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = link_graph.judged(read(spark, sf_dir, "pages"))
    return verdicts.select("page_id", "host", "path", "rule", "verdict")


ORACLES["op9_link_verdicts"] = link_graph.oracle()


@query
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


ORACLES["op4_license_scan"] = licenses.oracle()


@query
def op6_private_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private_data.detected(read(spark, sf_dir, "documents"))


@query
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


ORACLES["op11_filter_audit"] = filter_audit.ORACLE


@query
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(fill_in_middle.transformed(read(spark, sf_dir, "documents")))


ORACLES["op12_fill_in_middle"] = fill_in_middle.ORACLE


@query
def op13_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links.grouped(read(spark, sf_dir, "embeddings"))


ORACLES["op13_embedding_links"] = embedding_links.ORACLE


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
