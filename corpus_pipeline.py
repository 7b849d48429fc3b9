"""A training-corpus pipeline: quality rules, near-duplicates, secrets, source mix, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import mixing, packing, quality_rules, secrets, simhash
from tidemark.llm.common import Chain
from tidemark.llm.queries import tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def stages() -> list[tuple[str, Stage]]:
    """The stages of one run. Those marked whole write their input first; then what the run's earlier stages wrote can go."""
    run = Chain()
    return [
        ("quality_rules", run.step(quality_rules.keep_good, whole=False)),
        ("near_duplicates", run.step(simhash.keep_one, whole=True)),
        ("secrets", run.step(secrets.redact, whole=True)),
        ("mix", run.step(mixing.mixed, whole=True)),
        ("packing", run.step(lambda docs: packing.pack(docs, tokenizer_path()), whole=False)),
    ]


#: For who calls them one by one, each on the written result of the one before.
STAGES = stages()

#: The near-duplicate and packing stages can't be put in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in stages():
        docs = stage(spark, docs, sf_dir)
    return docs
