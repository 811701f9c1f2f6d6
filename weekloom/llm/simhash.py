"""SimHash near-duplicates, found by a generalised pigeonhole over groups of correlated bits."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weekloom.llm.components import components
from weekloom.llm.storage import stored

SEED = 42
WORDS = 4
MAX_DISTANCE = 4
BITS = 64
#: Numbers of bit groups that are weighed against each other.
GROUP_COUNTS = (2, 3, 4, 5)
#: Cost of writing and shuffling a probe, in verified candidates.
PROBE_COST = 20.0
#: Shingles whose bits are unpacked at once.
CHUNK = 1 << 16


def fingerprint(text: str | bytes | None, words: int = WORDS, seed: int = SEED) -> int:
    """The signed 64-bit SimHash of a text's word shingles; zero without words."""
    raw = text.encode() if isinstance(text, str) else text or b""
    found = raw.lower().split()  # on bytes: A-Z only, and the six ASCII white-space bytes
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(found) >= words:
        starts, ends = starts[: len(found) - words + 1], ends[words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), CHUNK):
        pairs = zip(starts[at : at + CHUNK].tolist(), ends[at : at + CHUNK].tolist(), strict=True)
        hashes = np.array([digest(joined[s:e], seed) for s, e in pairs], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view("<i8")[0])


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [fingerprint(t.as_py()) for t in batch.column("text").cast(pa.binary())]
        keys = {name: batch.column(name) for name in ("doc_id", "text_hash")}
        yield pa.record_batch(keys | {"fp": pa.array(found, pa.int64())})


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text_hash`` and ``fp`` of every whole text."""
    rows = docs.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash")
    )
    return rows.mapInArrow(_fingerprint_batches, "doc_id long, text_hash long, fp long")


def _gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((BITS, BITS))
    for batch in batches:
        values = batch.column("fp").to_numpy(zero_copy_only=False)
        values = values.astype("<i8").view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(values, axis=1, bitorder="little").astype(np.float32) * 2 - 1
        total += bits.T @ bits
    cells = np.arange(BITS * BITS)
    yield pa.record_batch({"cell": pa.array(cells), "total": pa.array(total.ravel())})


def bit_agreement(classes: DataFrame) -> np.ndarray:
    """Correlation-like mean products of the ±1 bits over all fingerprints (64 x 64)."""
    sums = classes.select("fp").mapInArrow(_gram, "cell long, total double")
    rows = sums.groupBy("cell").agg(F.sum("total").alias("total")).collect()  # 4,096 numbers
    found = np.zeros(BITS * BITS)
    for row in rows:
        found[row["cell"]] = row["total"]
    return found.reshape(BITS, BITS) / max(found.max(initial=0.0), 1.0)


def correlated_groups(agreement: np.ndarray, count: int) -> list[list[int]]:
    """Deal the bits into ``count`` groups of nearly equal size, each of correlated bits."""
    strength = np.abs(agreement).copy()
    np.fill_diagonal(strength, 0)
    left = list(range(BITS))
    groups = []
    for size in [len(part) for part in np.array_split(np.arange(BITS), count)]:
        group = [max(left, key=lambda b: (strength[b, left].sum(), -b))]
        left.remove(group[0])
        while len(group) < size:
            best = max(left, key=lambda b: (strength[b, group].sum(), -b))
            group.append(best)
            left.remove(best)
        groups.append(sorted(group))
    return groups


@dataclass(frozen=True)
class Plan:
    """Bit groups as masks, and the distance up to which each is probed (-1: not at all)."""

    masks: tuple[int, ...]
    radii: tuple[int, ...]
    cost: float


def signed(value: int) -> int:
    return value - (1 << BITS) if value >= 1 << (BITS - 1) else value


def _mask(bits) -> int:
    return signed(sum(1 << b for b in bits))


def allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Radii that sum to ``total`` at least cost; ``costs[i][r + 1]`` is group i's at radius r."""
    best = {0: (0.0, [])}
    for row in costs:
        grown: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, radii) in best.items():
            for r, more in enumerate(row, start=-1):
                option = (cost + more, [*radii, r])
                if used + r not in grown or option < grown[used + r]:
                    grown[used + r] = option
        best = grown
    return best[total]


def plan_probes(classes: DataFrame, max_distance: int = MAX_DISTANCE) -> Plan:
    """Choose bit groups and unequal radii by the candidates they are estimated to give.

    Two fingerprints within ``max_distance`` are within r_i in some group i whenever the radii of
    m groups sum to ``max_distance - m + 1`` (Qin et al., general pigeonhole).  Equal values in
    each group are counted over all fingerprints; a wider radius is scaled up as bits with the
    measured agreement would scale it.  Any choice finds the same pairs.
    """
    n = classes.count()
    agreement = bit_agreement(classes)
    options = [(m, correlated_groups(agreement, m)) for m in GROUP_COUNTS]
    masks = [(m, i, _mask(g)) for m, groups in options for i, g in enumerate(groups)]
    keys = F.array(*[
        F.struct(F.lit(m).alias("m"), F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(k)).alias("key"))
        for m, i, k in masks
    ])
    sizes = classes.select(F.explode(keys).alias("k")).groupBy("k.m", "k.i", "k.key").count()
    pairs = sizes.groupBy("m", "i").agg(F.sum(F.col("count").cast("double") ** 2).alias("pairs"))
    equal = {(r["m"], r["i"]): r["pairs"] / 2 for r in pairs.collect()}
    plans = []
    for m, groups in options:
        costs = []
        for i, group in enumerate(groups):
            tail = np.zeros(max_distance + 1)
            tail[0] = 1.0
            for b in group:  # distribution of the number of differing bits
                share = (1 + agreement[b, group].mean() ** 2) / 2  # chance that two rows agree
                tail = tail * share + np.concatenate(([0.0], tail[:-1])) * (1 - share)
            grown = np.cumsum(tail) / max(tail[0], 1e-300)
            balls = np.cumsum([math.comb(len(group), r) for r in range(max_distance + 1)])
            row = [0.0]
            for r in range(max_distance - m + 2):
                found = min(equal.get((m, i), 0.0) * grown[r], n * n / 2)
                row.append(PROBE_COST * n * balls[r] + found)
            costs.append(row)
        cost, radii = allocate(costs, max_distance - m + 1)
        plans.append(Plan(tuple(_mask(g) for g in groups), tuple(radii), cost))
    return min(plans, key=lambda p: p.cost)


def linked_pairs(classes: DataFrame, plan: Plan, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Pairs (a, b) of fingerprints with at most ``max_distance`` differing bits."""
    index, probes = [], []
    for i, (mask, radius) in enumerate(zip(plan.masks, plan.radii, strict=True)):
        if radius < 0:
            continue
        bits = [b for b in range(BITS) if (mask >> b) & 1]
        flips = [_mask(c) for r in range(radius + 1) for c in combinations(bits, r)]
        key = F.col("fp").bitwiseAND(F.lit(mask))
        part = F.lit(i).alias("part")
        index.append(classes.select(part, key.alias("key"), F.col("fp").alias("b")))
        flip = F.explode(F.array(*map(F.lit, flips))) if radius else F.lit(0).cast("long")
        probe = classes.select("fp", key.alias("key"), flip.alias("flip"))
        probes.append(probe.select(part, F.col("key").bitwiseXOR(F.col("flip")).alias("key"), F.col("fp").alias("a")))
    union = lambda parts: parts[0] if len(parts) == 1 else parts[0].union(union(parts[1:]))
    joined = union(probes).join(union(index), ["part", "key"])
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance
    return joined.where((F.col("a") < F.col("b")) & near).select("a", "b").distinct()


def simhash_groups(docs: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``, ``root`` and ``text_hash`` of every document.

    Texts are compared by the SimHash of all their word shingles.  Equal fingerprints are one
    class from the start; classes are linked where at most ``max_distance`` bits differ, and the
    component's id is the smallest ``doc_id`` in it.  Null and empty texts have the fingerprint
    zero, which links like any other.  Rows without ``doc_id`` take no part; repeated rows come
    out as often as they go in.  An empty table gives an empty result.  Columns other than
    ``doc_id`` and ``text`` are not read.
    """
    found = stored(fingerprints(docs), "fingerprints")
    classes = stored(found.groupBy("fp").agg(F.min("doc_id").alias("rep")), "classes")
    pairs = linked_pairs(classes, plan_probes(classes, max_distance), max_distance)
    groups = components(pairs).select(F.col("node").alias("fp"), F.col("component").alias("root"))
    rooted = classes.join(groups, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id", "root")
    return found.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "root", "text_hash"
    )


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group one row stays, of the smallest id and the smallest hash of its text.

    Of rows with one id and text that is any one.  Rows without ``doc_id`` go.
    """
    groups = stored(simhash_groups(docs), "groups")
    first = groups.groupBy("root").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"))
    kept = first.select("first.doc_id", F.col("first.text_hash").alias("_text_hash")).distinct()
    keys = ["doc_id", "_text_hash"]
    rows = docs.withColumn("_text_hash", F.xxhash64("text")).join(kept, keys, "left_semi")
    again = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    rows = rows.withColumn("_again", again).where("_again = 1")
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return groups.select("doc_id", "fingerprint", "component_id")


QUERIES = {"op8_simhash": op8_simhash}
SQL: dict[str, str] = {}
