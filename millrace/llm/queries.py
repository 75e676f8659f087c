"""The operators over the driver's tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm import (
    bpe,
    conversation_repair,
    language_id,
    line_quality,
    line_templates,
    nearest,
    packing,
    runs,
    simhash,
    size_aware_join,
    suffix_dedup,
    token_counts,
    token_records,
)

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return build(lambda table: spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet"))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return build

    return register


@query("op1_token_records")
def op1(table):
    return token_records.record_digests(table("documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


@query("op2_language_id")
def op2(table):
    return language_id.language_id(table("documents"))


@query("op3_suffix_dedup")
def op3(table):
    return suffix_dedup.digests(table("documents"))


@query("op4_nearest_vectors")
def op4(table):
    return nearest.nearest(table("embeddings"), query_every=20, k=20)


@query("op5_token_counts")
def op5(table):
    return token_counts.token_counts(table("documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op6_quality_rules", line_quality.SQL)
def op6(table):
    return line_quality.quality(table("documents"))


@query("op7_line_templates")
def op7(table):
    return line_templates.digests(table("documents"))


@query("op8_simhash_near_dedup")
def op8(table):
    return simhash.near_duplicates(table("documents"))


@query("op9_best_fit_packing")
def op9(table):
    return packing.packed(table("documents"), public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end_id=0)


@query("op10_bpe_round_trip")
def op10(table):
    return bpe.round_trip(table("documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op11_shingle_join")
def op11(table):
    return size_aware_join.similar_documents(table("documents"))


@query("op12_periodic_runs")
def op12(table):
    return runs.run_digests(table("documents"))


@query("op13_conversation_repair")
def op13(table):
    return conversation_repair.repair_digests(table("conversations"))
