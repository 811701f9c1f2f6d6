"""Vector code compression: product codebooks trained by exact integer arithmetic on float64 BLAS."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.llm.storage import stored

PARTS, ENTRIES, ROUNDS = 16, 64, 2
SCALE = 256
#: float64 holds every integer up to here; int64 up to LONG.
EXACT_BITS, LONG = 53, 2**63 - 1
#: Vectors compared at once.
CHUNK = 4_096
#: Digits of partial sums on their way to the driver: each limb fits a long summed over 2^32 tasks.
CARRY_BITS = 31
#: Labels with at least one row in so many are joined apart; there are at most as many of them.
HOT_SHARE = 1_000


def limb_width(terms: int) -> int:
    """Bits of a limb such that ``terms`` products of two limbs sum up to at most 2^53."""
    return (EXACT_BITS - math.ceil(math.log2(max(terms, 1)))) // 2


def limbs(values: np.ndarray, width: int) -> list[np.ndarray]:
    """Split int64 values into float64 limbs of ``width`` bits, lowest first, the last one signed."""
    parts = []
    while values.size and (values.max() >= 1 << width or values.min() < -(1 << width)):
        parts.append((values & ((1 << width) - 1)).astype(np.float64))
        values = values >> width
    return [*parts, values.astype(np.float64)]


def products(a: np.ndarray, b: np.ndarray, width: int | None = None) -> np.ndarray:
    """Dot products of the rows of ``a`` with the rows of ``b``, exact if they fit in int64.

    Each product of two limb matrices is a float64 BLAS call whose sums stay below 2^53, so
    no digit is lost whatever the order of summation.  They are shifted and added in int64, where
    overflow on the way cancels out.
    """
    width = width or limb_width(a.shape[1])
    total = np.zeros((len(a), len(b)), np.int64)
    right = limbs(b, width)
    for i, left in enumerate(limbs(a, width)):
        for j, other in enumerate(right):
            if width * (i + j) < 64:
                total += (left @ other.T).astype(np.int64) << np.int64(width * (i + j))
    return total


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest entry to each point, ties to the lower, and the squared distance.

    Both are integers: int64, or Python's where a distance might not fit in int64.
    """
    if points.dtype == object or entries.dtype == object:
        gaps = np.stack([((points - entry) ** 2).sum(axis=1) for entry in entries], axis=1)
        best = np.array([min(range(len(row)), key=row.__getitem__) for row in gaps], np.int64)
        return best, gaps[np.arange(len(points)), best]
    partial = (entries * entries).sum(axis=1)[None, :] - 2 * products(points, entries)
    best = partial.argmin(axis=1)
    return best, partial[np.arange(len(points)), best] + (points * points).sum(axis=1)


def narrow(values: np.ndarray, terms: int) -> np.ndarray:
    """Integers as int64 if squared distances over ``terms`` of them fit, else as Python integers."""
    small = not values.size or terms * (2 * int(abs(values).max())) ** 2 <= LONG
    return values.astype(np.int64) if small else values.astype(object)


def scaled(components: np.ndarray, terms: int) -> np.ndarray:
    """``floor(SCALE * x)`` of doubles, exactly."""
    if components.size and np.abs(components).max() >= 2.0**45:
        # beyond 2^53 a double is an integer; below, times a power of two loses nothing
        whole = [int(x) * SCALE if abs(x) >= 2.0**53 else math.floor(SCALE * x) for x in components.flat]
        return narrow(np.array(whole, object).reshape(components.shape), terms)
    return narrow(np.floor(components * SCALE).astype(np.int64), terms)


@dataclass(frozen=True)
class Codebooks:
    """Integer entries by part: ``entries[part][entry, position]``, Python integers."""

    entries: tuple[np.ndarray, ...]

    @property
    def width(self) -> int:
        return self.entries[0].shape[1]

    def digest(self) -> str:
        numbers = (str(int(x)) for part in self.entries for x in part.flat)
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()

    def assign(self, vectors: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Part, points, entry numbers and squared distances, part by part."""
        for part, entries in enumerate(self.entries):
            points = vectors[:, part * self.width : (part + 1) * self.width]
            both = narrow(points, self.width), narrow(entries, self.width)
            best, error = nearest(*both)
            yield part, points, best, error


def usable(vectors: DataFrame) -> DataFrame:
    """Rows whose vector is not null and holds no null or non-finite component, as doubles."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    double = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long"), double.alias("embedding"), "label")
    return rows.where(F.coalesce(~F.exists("embedding", bad), F.lit(False)))


def _matrices(
    batches: Iterator[pa.RecordBatch], width: int
) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Scaled integer vectors of at most CHUNK rows, shorter vectors filled up with zeros."""
    for batch in batches:
        for start in range(0, batch.num_rows, CHUNK):
            rows = batch.slice(start, CHUNK)
            column = rows.column("embedding")
            sizes = np.diff(column.offsets.to_numpy())
            filled = np.zeros((len(sizes), width))
            values = column.flatten().to_numpy(zero_copy_only=False)
            filled[np.arange(width) < sizes[:, None]] = values
            yield rows, scaled(filled, width)


def _part_sums(books: Codebooks, entries: int):
    """A function from batches to limbs of the sums, and counts, of the points of each entry."""
    width, parts = books.width, len(books.entries)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts * entries, width), object)
        counts = np.zeros(parts * entries, np.int64)
        for _, vectors in _matrices(batches, parts * width):
            for part, points, best, _ in books.assign(vectors):
                cells = slice(part * entries, (part + 1) * entries)
                counts[cells] += np.bincount(best, minlength=entries)
                sums[cells] += _grouped(points, best, entries)
        cell = np.flatnonzero(counts)
        position = np.tile(np.arange(width), len(cell))
        owner, left, limb = np.repeat(cell, width), sums[cell].ravel(), 0
        yield _limb_rows(cell, np.full(len(cell), -1), 0, counts[cell])
        while any(left):
            sign = np.where(left < 0, -1, 1)
            size = abs(left)
            part = sign * (size & ((1 << CARRY_BITS) - 1))
            yield _limb_rows(owner, position, limb, part.astype(np.int64))
            left, limb = sign * (size >> CARRY_BITS), limb + 1

    return add


def _grouped(points: np.ndarray, best: np.ndarray, entries: int) -> np.ndarray:
    """Sums of the points of each entry, as Python integers."""
    total = np.zeros((entries, points.shape[1]), object)
    if points.dtype == object:
        np.add.at(total, best, points)
        return total
    width = EXACT_BITS - CHUNK.bit_length()
    for i, limb in enumerate(limbs(points, width)):
        for j in range(points.shape[1]):
            sums = np.bincount(best, limb[:, j], entries).astype(np.int64).astype(object)
            total[:, j] += sums << (width * i) if i else sums
    return total


def _limb_rows(cell, position, limb: int, value) -> pa.RecordBatch:
    return pa.record_batch(
        {
            "cell": pa.array(cell, pa.int32()),
            "position": pa.array(position, pa.int32()),
            "limb": pa.array(np.full(len(cell), limb), pa.int32()),
            "value": pa.array(value, pa.int64()),
        }
    )


def _first_books(kept: DataFrame, parts: int, entries: int) -> Codebooks | None:
    """The vectors of the smallest ids, cut into parts; None without vectors."""
    size = kept.agg(F.max(F.size("embedding"))).first()[0]
    if size is None:
        return None
    width = max(1, -(-size // parts))
    order = [F.col("vec_id").asc_nulls_last(), "embedding"]
    first = kept.orderBy(*order).limit(entries).select("embedding").collect()
    filled = np.zeros((len(first), parts * width))
    for row, vector in zip(filled, first, strict=True):
        row[: len(vector[0])] = vector[0]
    whole = scaled(filled, parts * width).astype(object)
    return Codebooks(tuple(np.hsplit(whole, parts)))


def _next_books(kept: DataFrame, books: Codebooks) -> Codebooks:
    """Each entry replaced by the floor of the mean of its points; unused entries stay.

    Sums come to the driver as limbs, ``parts * entries * width`` numbers of some limbs each.
    """
    entries = len(books.entries[0])
    schema = "cell int, position int, limb int, value long"
    partial = kept.select("embedding").mapInArrow(_part_sums(books, entries), schema)
    summed = partial.groupBy("cell", "position", "limb").agg(F.sum("value").alias("value"))
    counts: dict[int, int] = {}
    sums: dict[tuple[int, int], int] = {}
    for cell, position, limb, value in summed.collect():
        if position < 0:
            counts[cell] = value
        else:
            at = (cell, position)
            sums[at] = sums.get(at, 0) + (value << (CARRY_BITS * limb))
    fresh = [part.copy() for part in books.entries]
    for cell, count in counts.items():
        part, entry = divmod(cell, entries)
        for position in range(books.width):
            fresh[part][entry, position] = sums.get((cell, position), 0) // count
    return Codebooks(tuple(fresh))


def train(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> Codebooks | None:
    """Codebooks after ``rounds`` passes over all usable vectors; None if there are none."""
    kept = usable(vectors)
    books = _first_books(kept, parts, entries)
    for _ in range(rounds if books else 0):
        books = _next_books(kept, books)
    return books


def encode(vectors: DataFrame, books: Codebooks | None) -> DataFrame:
    """``vec_id``, ``label``, ``codes`` (entry numbers by part) and ``error`` of usable vectors.

    ``error`` sums the squared distances of all parts; it is null where it does not fit in a long.
    """
    kept = usable(vectors)
    kind = kept.schema["label"].dataType.simpleString()
    schema = f"vec_id long, label {kind}, codes binary, error long"

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if books is None:
            return
        for rows, vectors in _matrices(batches, len(books.entries) * books.width):
            codes = np.zeros((len(vectors), len(books.entries)), np.uint8)
            error = np.zeros(len(vectors), object)
            for part, _, best, gap in books.assign(vectors):
                codes[:, part] = best
                error += gap
            yield pa.record_batch(
                {
                    "vec_id": rows.column("vec_id"),
                    "label": rows.column("label"),
                    "codes": pa.array([c.tobytes() for c in codes], pa.binary()),
                    "error": pa.array([e if e <= LONG else None for e in error], pa.int64()),
                }
            )

    return kept.mapInArrow(code, schema)


def with_label_error(coded: DataFrame, share: int = HOT_SHARE) -> DataFrame:
    """Add ``label_error``, the sum of ``error`` over the rows of an equal label, nulls together.

    Labels with one row in ``share`` or more, ``share`` labels at most, are broadcast; the rows of all others
    meet their sums in a shuffle.  The sum is null if one of its errors is, or if it does not fit in a long.
    """
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    whole = F.when(F.count("error") == F.count(F.lit(1)), total.try_cast("long"))
    sums = coded.groupBy(F.col("label").alias("_label")).agg(
        whole.alias("label_error"), F.count(F.lit(1)).alias("_rows")
    )
    sums = stored(sums, "label-errors")
    least = sums.agg(F.sum("_rows")).first()[0] or 0
    hot = sums.where(F.col("_rows") * share >= least).drop("_rows")
    cold = sums.where(F.col("_rows") * share < least).drop("_rows")
    same = F.col("label").eqNullSafe(F.col("_label"))
    frequent = coded.join(F.broadcast(hot), same)
    rare = coded.join(F.broadcast(hot), same, "left_anti").join(cold, same)
    return frequent.unionByName(rare).drop("_label")


def op11_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes and errors of all usable vectors.

    Vectors shorter than the longest count as filled up with zeros, to a multiple of 16
    components.  Rows without ``vec_id`` are coded and come last among the vectors that start the
    codebooks; rows with one id go by their components.  Repeated rows all stay.  Without usable
    vectors there are no rows.
    """
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    books = train(vectors)
    coded = with_label_error(stored(encode(vectors, books), "codes"))
    return coded.select(
        "vec_id",
        F.lower(F.hex("codes")).alias("code"),
        "error",
        "label_error",
        F.lit(books.digest() if books else "").alias("codebooks_sha256"),
    )


QUERIES = {"op11_codes": op11_codes}


def _sql() -> str:
    """Two rounds and the final assignment, each as a table; components as rows of a part."""
    text = f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label,
    list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), points AS (
  SELECT r, part, v[part * len(v) // {PARTS} + 1 : (part + 1) * len(v) // {PARTS}] AS p
  FROM kept, range({PARTS}) AS parts(part)
), c0 AS (
  SELECT part, r - 1 AS entry, p AS c FROM points WHERE r <= {ENTRIES}
)"""
    for i in range(ROUNDS + 1):
        text += f""", a{i} AS (
  SELECT r, part, p, min({{'d': list_sum(list_transform(list_zip(p, c),
    lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'e': entry}}) AS m
  FROM points JOIN c{i} USING (part) GROUP BY r, part, p
)"""
        if i < ROUNDS:
            text += f""", u{i} AS (
  SELECT part, entry, list(x ORDER BY j) AS c FROM (
    SELECT part, m.e AS entry, j, floor(sum(p[j + 1]::HUGEINT)::DOUBLE / count(*))::BIGINT AS x
    FROM a{i}, range(len(p)) AS js(j) GROUP BY part, m.e, j
  ) GROUP BY part, entry
), c{i + 1} AS (
  SELECT part, entry, coalesce(u{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN u{i} USING (part, entry)
)"""
    return text + f""", coded AS (
  SELECT r, string_agg(lpad(lower(hex(m.e)), 2, '0'), '' ORDER BY part) AS code,
    sum(m.d)::BIGINT AS error FROM a{ROUNDS} GROUP BY r
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM c{ROUNDS})
    AS codebooks_sha256
FROM kept JOIN coded USING (r)
"""


SQL = {"op11_codes": _sql()}
