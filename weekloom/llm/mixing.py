"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.llm.storage import stored

#: A Poisson count of a larger mean is a sum of independent counts with means up to this.
PART_MEAN = 32.0
#: Hex digits of the hash that make a uniform number: 52 bits.
DIGITS = 13
#: Terms that leave less than 2**-53 of a Poisson distribution of mean ``PART_MEAN``.
TERMS = 120
#: So many sources at most, with a name and a number each, are sent to all executors.
BROADCAST_SOURCES = 50_000


def uniform(*parts: Column | str) -> Column:
    """A number in [0, 1) from the hash of the parts, the same in every run."""
    digest = F.md5(F.concat_ws(":", *[F.col(p) if isinstance(p, str) else p for p in parts]))
    bits = F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("long")
    return bits / F.lit(float(16**DIGITS))


def poisson_inverse(rate: Column, u: Column) -> Column:
    """The smallest k whose cumulated Poisson probability exceeds ``u`` (mean up to PART_MEAN)."""
    start = F.struct(
        F.exp(-rate).alias("term"), F.exp(-rate).alias("total"), F.lit(0).cast("long").alias("k")
    )

    def step(state: Column, i: Column) -> Column:
        term = state["term"] * rate / i
        return F.struct(
            term.alias("term"),
            (state["total"] + term).alias("total"),
            (state["k"] + (state["total"] <= u).cast("long")).alias("k"),
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, step, lambda s: s["k"])


def source_rates(docs: DataFrame, weights: Mapping[str | None, float] | None = None) -> DataFrame:
    """Mean repetitions of a document by source: target share over present share of the text.

    ``weights`` gives each source its share of the mix (scaled to sum 1; a source not named gets
    none); without it every source, the null source included, gets the same.  Shares are
    measured in characters over all documents, so the mix has about as much text as the input.
    A source without any text keeps its documents once on average, if it has a weight.
    """
    mass = docs.groupBy("source").agg(F.sum(F.length(F.coalesce("text", F.lit("")))).alias("mass"))
    mass = stored(mass, "mass")
    if weights is None:
        weighted = mass.withColumn("weight", F.lit(1.0))
    else:
        schema = "given string, weight double"
        rows = [(k, float(v)) for k, v in weights.items()]
        given = docs.sparkSession.createDataFrame(rows, schema)
        weighted = mass.join(given, mass["source"].eqNullSafe(given["given"])).drop("given")
    total = mass.agg(F.sum("mass")).first()[0] or 0
    weight = weighted.agg(F.sum("weight")).first()[0] or 1.0
    share = F.col("weight") / F.lit(float(weight))
    rate = F.when(F.col("mass") > 0, share * F.lit(total) / F.col("mass"))
    return weighted.select(
        F.col("source").alias("_source"),
        F.coalesce(rate, F.when(F.col("weight") > 0, 1.0).otherwise(0.0)).alias("_rate"),
    )


def mix_sources(
    docs: DataFrame, weights: Mapping[str | None, float] | None = None, seed: int = 42
) -> DataFrame:
    """Repeat each document a Poisson number of times and shuffle all copies globally.

    The count comes from inverting the Poisson distribution at a number hashed from seed and
    ``doc_id``; its mean is the source's rate (:func:`source_rates`).  A null ``doc_id`` is hashed
    as the empty string, rows of equal ``doc_id`` get equal counts, null and empty texts are
    repeated like others.  Copies carry all columns of ``docs`` and ``copy`` (from 1); a column of that name is
    replaced.  The order is that of a hash of seed, ``doc_id`` and copy, within partitions to
    which another hash of it deals the copies.  An empty table stays empty.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns if c != "copy"]
    packed = docs.select("doc_id", "source", F.struct(*columns).alias("_row"))
    rates = stored(source_rates(docs, weights), "rates")
    if rates.count() <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)  # more sources are joined by a shuffle
    joined = packed.join(rates, packed["source"].eqNullSafe(rates["_source"]))
    parts = F.greatest(F.lit(1), F.ceil(F.col("_rate") / F.lit(PART_MEAN)))
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    part_rate = F.col("_rate") / parts
    count = F.aggregate(
        F.sequence(F.lit(1).cast("long"), parts.cast("long")),
        F.lit(0).cast("long"),
        lambda total, part: total
        + poisson_inverse(part_rate, uniform(F.lit(str(seed)), name, part.cast("string"))),
    )
    copies = joined.withColumn("_n", count).where(F.col("_n") > 0)
    copies = copies.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
    key = F.md5(F.concat_ws(":", F.lit(f"order{seed}"), name, F.col("copy").cast("string")))
    dealt = copies.select("_row", "copy", key.alias("_key")).repartition("_key")
    return dealt.sortWithinPartitions("_key").select("_row.*", "copy")


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: equal shares for all sources; a repeated document is as many equal rows."""
    mixed = mix_sources(docs)
    return mixed.select(*[F.col(f"`{c}`") for c in docs.columns])


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal shares for all sources."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix_sources(docs.select("doc_id", "text", "lang", "source", "n_chars"))


QUERIES = {"op5_mix_sources": op5_mix_sources}

SQL = {
    "op5_mix_sources": f"""
WITH mass AS (SELECT source, sum(length(coalesce(text, ''))) AS mass FROM documents GROUP BY source),
rates AS (SELECT source, coalesce((1.0::DOUBLE / (SELECT count(*) FROM mass)) * (SELECT sum(mass) FROM mass)
  / nullif(mass, 0), 1.0)::DOUBLE AS rate FROM mass),
parts AS (
  SELECT d.*, unnest(range(1, greatest(1, ceil(rate / {PART_MEAN}))::BIGINT + 1)) AS part,
    rate / greatest(1, ceil(rate / {PART_MEAN})) AS part_rate
  FROM documents d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source),
drawn AS (
  SELECT *, ('0x' || substr(md5('42:' || coalesce(doc_id::VARCHAR, '') || ':' || part), 1, {DIGITS})
    )::BIGINT / {float(16**DIGITS)!r} AS u FROM parts),
terms AS (SELECT unnest(range(0, {TERMS})) AS k),
reached AS (
  SELECT part_rate, k, sum(exp(k * ln(part_rate) - part_rate - lgamma(k + 1)))
    OVER (PARTITION BY part_rate ORDER BY k) AS total
  FROM (SELECT DISTINCT part_rate FROM parts WHERE part_rate > 0), terms),
counts AS (
  SELECT d.doc_id, d.part, count(r.k) AS n
  FROM drawn d LEFT JOIN reached r ON d.part_rate = r.part_rate AND r.total <= d.u
  GROUP BY d.doc_id, d.part),
summed AS (SELECT doc_id, sum(n)::BIGINT AS n FROM counts GROUP BY doc_id)
SELECT d.doc_id, text, lang, source, n_chars, unnest(range(1, n + 1)) AS copy
FROM documents d JOIN summed s ON d.doc_id = s.doc_id
"""
}
