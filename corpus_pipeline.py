"""The corpus pipeline: five stages over ``documents``, each one an operator.

Each stage's result is written as Parquet and read again as the next one's
documents, so a lost executor or a failed stage never repeats the ones before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from smogline.llm import decontaminate, language_id, mixing, sharding, simhash
from smogline.session import scratch_path

STAGES = [
    ("language_id", language_id.stage),
    ("simhash_dedup", simhash.stage),
    ("decontaminate", decontaminate.stage),
    ("mix", mixing.stage),
    ("shard", sharding.stage),
]

# language ID is a fitted model and simhash an XXH64 bit vote: no DuckDB SQL states them;
# tests/llm compares run() with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
