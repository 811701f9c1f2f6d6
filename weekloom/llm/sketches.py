"""Document fingerprints: threshold-scaled sketches of word shingles."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.llm.texts import BLOCK_BYTES, RADIX, WHITE, blocks, mix, span_hashes, spans, utf8

#: Words of a shingle.
WORDS = 5
#: One shingle hash in 2^FRACTION_BITS is below the threshold and retained.
FRACTION_BITS = 3
#: Ranges of documents for each shuffle partition, and sampled documents for each range.
RANGES, SAMPLED = 8, 32

UPPER = np.arange(256, dtype=np.uint8)
UPPER[65:91] += 32  # A-Z to a-z


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of the given texts (UTF-8, one after another), and the text of each.

    Words are runs of bytes other than ASCII white space, A-Z lower-cased.  A text of fewer
    words has one shingle, all of them; one without words has none.
    """
    data = UPPER[data]
    starts, lengths, rows = spans(~WHITE[data], offsets)
    # hashing takes some numbers for each byte, so words go in runs of bounded size
    cuts = np.searchsorted(np.cumsum(lengths), np.arange(BLOCK_BYTES, lengths.sum(), BLOCK_BYTES))
    hashes = [
        span_hashes(data, s, n)
        for s, n in zip(np.split(starts, cuts), np.split(lengths, cuts), strict=True)
    ]
    hashes = np.concatenate(hashes)
    counts = np.bincount(rows, minlength=len(offsets) - 1)
    first = np.cumsum(counts) - counts
    total = np.zeros(len(hashes), np.uint64)
    for ahead in range(words):
        factor = np.uint64(pow(int(RADIX), ahead + 1, 1 << 64))
        inside = np.flatnonzero(np.arange(len(hashes)) - first[rows] + ahead < counts[rows])
        total[inside] += hashes[inside + ahead] * factor
    kept = np.arange(len(hashes)) - first[rows] <= np.maximum(counts - words, 0)[rows]
    return mix(total[kept]), rows[kept]


def sketch_texts(
    data: np.ndarray, offsets: np.ndarray, words: int = WORDS, bits: int = FRACTION_BITS
) -> list[np.ndarray]:
    """The sketch of each text: its distinct shingle hashes below 2^(64 - bits), ascending.

    A text none of whose hashes is that small keeps its smallest one; one without words has an
    empty sketch.
    """
    hashes, rows = shingle_hashes(data, offsets, words)
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    small = hashes >> np.uint64(64 - bits) == 0
    new_row = np.append(True, rows[1:] != rows[:-1]) if len(rows) else np.zeros(0, bool)
    fresh = new_row | np.append(True, hashes[1:] != hashes[:-1])[: len(hashes)]
    kept = (small & fresh) | new_row  # the smallest hash of a text is the first of its row
    ends = np.searchsorted(rows[kept], np.arange(len(offsets) - 1), "right")
    return np.split(hashes[kept], ends[:-1])


def merge(sketches: Sequence[np.ndarray], bits: int = FRACTION_BITS) -> np.ndarray:
    """The sketch of all the texts' shingles together, from the sketches alone.

    Exactly what sketching the union would give: the hashes below the threshold of any, or the
    smallest of all where there are none.
    """
    union = np.unique(np.concatenate([np.zeros(0, np.uint64), *sketches]))
    small = union[union >> np.uint64(64 - bits) == 0]
    return small if len(small) else union[:1]


def containment(inner: np.ndarray, outer: np.ndarray) -> float:
    """Estimated share of the shingles of ``inner`` that ``outer`` holds too.

    Both retain the same part of the hash values, so neither size matters: a short text that
    stands in a long one has containment 1.  Two empty sketches are alike, 1; an empty one and
    another are not, 0.
    """
    if len(inner) == 0 or len(outer) == 0:
        return float(len(inner) == len(outer))
    at = np.minimum(np.searchsorted(outer, inner), len(outer) - 1)
    return float(np.count_nonzero(outer[at] == inner) / len(inner))


def written(sketch: np.ndarray) -> str:
    """A sketch as text, 16 hex digits a hash."""
    return sketch.astype(">u8").tobytes().hex()


def parsed(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u8").astype(np.uint64)


def fingerprints(
    docs: DataFrame, words: int = WORDS, bits: int = FRACTION_BITS
) -> DataFrame:
    """``doc_id`` and ``fingerprint`` (the sketch, 16 hex digits a hash) of every whole text.

    A null text counts as empty; texts without words have the empty fingerprint.  Rows stay as
    they are, repeated ids and null ids too, and nothing is shuffled.
    """

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in blocks(batches):
            found = [written(s) for s in sketch_texts(data, offsets, words, bits)]
            yield pa.record_batch({"doc_id": rows.column("doc_id"), "fingerprint": pa.array(found, pa.string())})

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(sketch, "doc_id long, fingerprint string")


def hashes_of(fingerprint: Column | str) -> Column:
    """The hashes of a fingerprint as an array of hex strings, for Spark's array functions and joins."""
    return F.filter(F.split(fingerprint, "(?<=\\G.{16})"), lambda part: part != "")


def merged(found: DataFrame, key: str, bits: int = FRACTION_BITS) -> DataFrame:
    """``key`` and ``hash``: the sketch of all texts of each key together, a row for each hash.

    ``found`` has ``key`` and ``fingerprint``.  Hashes stay rows, as a key may hold any number of texts;
    they are made distinct before and after the shuffle.
    """
    rows = found.select(key, F.explode(hashes_of("fingerprint")).alias("hash")).distinct()
    limit = f"{1 << (64 - bits):016x}"
    small = rows.where(F.col("hash") < limit)
    least = rows.groupBy(key).agg(F.min("hash").alias("hash")).where(F.col("hash") >= limit)
    return small.unionByName(least)


# -- a document and the one after it ------------------------------------------------------

EDITED = """doc_id long, n_chars long, edited_sha256 string, fingerprint string,
    edited_fingerprint string, near_edited double, near_next double"""


def _place() -> Column:
    """Where a row stands: descending ids, null ids last, equal ids by the hash of their text."""
    down = F.bitwise_not(F.coalesce("doc_id", F.lit(0).cast("long")))
    return F.struct(
        F.col("doc_id").isNull().alias("none"), down.alias("down"), F.xxhash64("text").alias("hash")
    )


class Place(NamedTuple):
    none: bool
    down: int
    hash: int


def _splits(placed: DataFrame, ranges: int) -> list[Place]:
    """The first row's place, and those of sampled rows that cut the order into ``ranges`` parts.

    The sample is drawn by a hash, some SAMPLED places for each range, so its size depends on
    ``ranges`` alone.  It decides how evenly rows are dealt, not what comes out.
    """
    rows, first = placed.agg(F.count(F.lit(1)), F.min("place")).first()
    if not rows:
        return []
    every = max(1, rows // (ranges * SAMPLED))
    picked = F.pmod(F.xxhash64("place.none", "place.down", "place.hash"), F.lit(every)) == 0
    sample = sorted(Place(*row[0]) for row in placed.where(picked).select("place").distinct().collect())
    cuts = sample[:: max(1, -(-len(sample) // ranges))]
    return sorted({Place(*first), *cuts})


def _range(splits: list[Place]) -> Column:
    """Number of the range of a place: a binary search for the last split not after it."""
    table = F.array(*(F.struct(*(F.lit(part) for part in split)) for split in splits))
    table = table.cast("array<struct<none: boolean, down: bigint, hash: bigint>>")
    steps = F.array(*(F.lit(1 << i) for i in reversed(range(len(splits).bit_length()))))
    key = F.struct("place.none", "place.down", "place.hash")

    def search(at: Column, step: Column) -> Column:
        ahead = at + step
        return F.when((ahead < len(splits)) & (F.get(table, ahead) <= key), ahead).otherwise(at)

    return F.aggregate(steps, F.lit(0), search)


def _with_next(
    batches: Iterator[pa.RecordBatch], words: int, bits: int
) -> Iterator[list[tuple[tuple, tuple]]]:
    """Rows (guest, id, text, sketch) with the rows after them, a bounded block at a time.

    Rows come sorted, and after the last row of each range comes the first of the next as a guest.
    """
    last = None
    for rows, data, offsets in blocks(batches):
        texts = [data[s:e].tobytes() for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        here = zip(
            rows.column("guest").to_pylist(),
            rows.column("doc_id").to_pylist(),
            texts,
            sketch_texts(data, offsets, words, bits),
            strict=True,
        )
        here = [*([last] if last else []), *here]
        last = here[-1]
        yield [(row, after) for row, after in zip(here, here[1:], strict=False) if not row[0]]


def _edit(text: bytes, after: bytes) -> tuple[int, bytes]:
    """Length of a text, and the text with its last third replaced by the start of another."""
    # bytes that aren't UTF-8 count as a code point each and come back as they were
    chars = text.decode(errors="surrogateescape")
    third = len(chars) // 3
    # a code point takes four bytes at most
    start = after[: 4 * third + 4].decode(errors="surrogateescape")[:third]
    return len(chars), (chars[: len(chars) - third] + start).encode(errors="surrogateescape")


def edited_likeness(docs: DataFrame, words: int = WORDS, bits: int = FRACTION_BITS) -> DataFrame:
    """Each document's fingerprint beside those of its edited text and of the next document.

    The edited text has the last third of its code points replaced by the first as many (or all)
    of the next document in descending order of ``doc_id``; after the last comes the first.
    ``near_edited`` and ``near_next`` are the shares of the document's shingles that the other holds
    too, by :func:`containment`.

    A null text counts as empty.  Rows without ``doc_id`` come after all others; rows with one id
    go by a hash of their text, equal rows follow each other.  A single row is its own next.
    Each row gives one row; an empty table gives none.  Columns besides the two aren't read.

    The documents are dealt to ranges of the order by places of sampled rows, and the first document of
    each range is sent to the range before it, so each range can be read from start to end on its own.
    Texts are shuffled once.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    placed = rows.withColumn("place", _place())
    splits = _splits(placed, RANGES * int(spark.conf.get("spark.sql.shuffle.partitions")))
    if not splits:
        return spark.createDataFrame([], EDITED)
    before = [(*split, (i - 1) % len(splits)) for i, split in enumerate(splits)]
    firsts = spark.createDataFrame(before, "none boolean, down long, hash long, range int")
    guests = placed.select("place.*", "text").join(F.broadcast(firsts), ["none", "down", "hash"])
    guests = guests.groupBy("range").agg(F.min("text").alias("text"))
    order = ["range", "guest", "none", "down", "hash", "text"]
    hosts = placed.select(_range(splits).alias("range"), F.lit(False).alias("guest"), "doc_id", "place.*", "text")
    dealt = hosts.unionByName(guests.withColumn("guest", F.lit(True)), allowMissingColumns=True)
    dealt = dealt.repartition("range").sortWithinPartitions(*order)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pairs in _with_next(batches, words, bits):
            edits = [_edit(row[2], after[2]) for row, after in pairs]
            changed = pa.array([text for _, text in edits], pa.large_binary())
            sketches = sketch_texts(*utf8(changed), words, bits)
            yield pa.record_batch(
                {
                    "doc_id": pa.array([row[1] for row, _ in pairs], pa.int64()),
                    "n_chars": pa.array([n for n, _ in edits], pa.int64()),
                    "edited_sha256": pa.array(
                        [hashlib.sha256(text).hexdigest() for _, text in edits], pa.string()
                    ),
                    "fingerprint": pa.array([written(row[3]) for row, _ in pairs], pa.string()),
                    "edited_fingerprint": pa.array([written(s) for s in sketches], pa.string()),
                    "near_edited": pa.array(
                        [containment(row[3], s) for (row, _), s in zip(pairs, sketches, strict=True)],
                        pa.float64(),
                    ),
                    "near_next": pa.array(
                        [containment(row[3], after[3]) for row, after in pairs], pa.float64()
                    ),
                }
            )

    return dealt.select("guest", "doc_id", "text").mapInArrow(compare, EDITED)


def op12_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_likeness(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op12_sketches": op12_sketches}

#: Polynomial hashes of words have no counterpart in SQL.
SQL: dict[str, str] = {}
