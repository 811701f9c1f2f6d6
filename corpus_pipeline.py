"""From raw documents to token ids: the stages of the corpus pipeline, each over all rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from weekloom.llm.mixing import mix_stage
from weekloom.llm.pieces import encode_stage
from weekloom.llm.quality import drop_rejected
from weekloom.llm.repeats import drop_repeats
from weekloom.llm.simhash import drop_near_duplicates
from weekloom.llm.storage import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", drop_rejected),
    ("SimHash near-dedup", drop_near_duplicates),
    ("suffix-array dedup", drop_repeats),
    ("mixing sources to target weights", mix_stage),
    ("SentencePiece encoding and decoding", encode_stage),
]

#: Models and hashes without a SQL counterpart take part in the stages.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents, each to what its predecessor stored."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)
