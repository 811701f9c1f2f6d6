"""Quality classifier: histogram gradient-boosted trees over statistics of whole documents."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.llm.storage import stored
from weekloom.llm.texts import WHITE, blocks, span_hashes, spans

#: Labelled documents that the trees are fitted on, at most; chosen by a hash of the id.
TRAIN_ROWS = 20_000
THRESHOLD = 0.7
TREES, DEPTH, BINS, RATE = 60, 4, 64, 0.15
#: Least weight (hessian) of a leaf, and the L2 penalty on leaf values.
LEAF_WEIGHT, PENALTY = 3.0, 1.0

CLASSES = ("lower", "upper", "digit", "blank", "line", "period", "comma", "mark", "symbol", "bar", "high")


def _byte_classes() -> np.ndarray:
    """The class of each byte value, an index into CLASSES; control bytes count as symbols."""
    table = np.full(256, CLASSES.index("symbol"), np.uint8)
    groups = {
        "lower": b"abcdefghijklmnopqrstuvwxyz",
        "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        "digit": b"0123456789",
        "blank": b" \t\x0b\x0c",
        "line": b"\n\r",
        "period": b".",
        "comma": b",",
        "mark": b"!?;:'\"()-",
        "bar": b"|",
        "high": bytes(range(128, 256)),
    }
    for name, members in groups.items():
        table[list(members)] = CLASSES.index(name)
    return table


BYTE_CLASS = _byte_classes()

STATISTICS = (
    "log_bytes",
    "log_words",
    "word_length",
    "longest_word",
    "short_words",
    "symbol_end",
    "adjacent_repeats",
    "distinct_words",
    "log_lines",
    "line_length",
    "distinct_lines",
    *(f"share_{name}" for name in CLASSES),
)


def _distinct(rows: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """How many different hashes each row has."""
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return np.bincount(rows[fresh], minlength=n)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of STATISTICS for each text; an empty text has zeros."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    out = np.zeros((n, len(STATISTICS)), np.float32)
    if len(data) == 0:
        return out
    kinds = BYTE_CLASS[data]
    row = np.repeat(np.arange(n, dtype=np.int64) * 16, size)
    shares = np.bincount(row + kinds, minlength=16 * n).reshape(n, 16)[:, : len(CLASSES)]
    starts, lengths, rows = spans(~WHITE[data], offsets)
    words = np.bincount(rows, minlength=n)
    hashes = span_hashes(data, starts, lengths)
    some = np.maximum(words, 1)
    repeat = (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])
    ends = kinds[starts + lengths - 1] if len(starts) else kinds[:0]
    longest = np.zeros(n)
    np.maximum.at(longest, rows, lengths)
    lines = spans(data != 0x0A, offsets)
    count = np.bincount(lines[2], minlength=n)
    line_hashes = span_hashes(data, lines[0], lines[1])
    out[:, 0] = np.log1p(size)
    out[:, 1] = np.log1p(words)
    out[:, 2] = np.bincount(rows, weights=lengths, minlength=n) / some
    out[:, 3] = longest
    out[:, 4] = np.bincount(rows[lengths <= 2], minlength=n) / some
    out[:, 5] = np.bincount(rows[ends == CLASSES.index("symbol")], minlength=n) / some
    out[:, 6] = np.bincount(rows[1:][repeat], minlength=n) / some
    out[:, 7] = _distinct(rows, hashes, n) / some
    out[:, 8] = np.log1p(count)
    out[:, 9] = np.bincount(lines[2], weights=lines[1], minlength=n) / np.maximum(count, 1)
    out[:, 10] = _distinct(lines[2], line_hashes, n) / np.maximum(count, 1)
    out[:, 11:] = shares / np.maximum(size, 1)[:, None]
    return out


def _statistic_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in blocks(batches):
        found = statistics(data, offsets)
        flat = pa.array(found.ravel(), pa.float32())
        steps = pa.array(np.arange(len(found) + 1, dtype=np.int32) * found.shape[1])
        column = pa.ListArray.from_arrays(steps, flat)
        keys = {name: batch.column(name) for name in ("doc_id", "text_hash")}
        yield pa.record_batch(keys | {"stats": column})


def document_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text_hash`` and ``stats``, an array of STATISTICS, of every whole text."""
    rows = docs.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash")
    )
    return rows.mapInArrow(_statistic_batches, "doc_id long, text_hash long, stats array<float>")


@dataclass(frozen=True)
class Trees:
    """All trees one after another in flat arrays; a leaf points to itself."""

    base: float
    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row; all rows walk down one tree together."""
        total = np.full(len(x), self.base)
        at = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                low = x[at, self.feature[node]] <= self.cut[node]
                node = np.where(low, self.left[node], self.right[node])
            total += self.value[node]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _best_split(hist_g, hist_h, penalty, least):
    """Best (gain, feature, bin) of a node from its histograms (features x bins)."""
    g, h = hist_g.cumsum(axis=1), hist_h.cumsum(axis=1)
    g_all, h_all = g[:, -1:], h[:, -1:]
    allowed = (h >= least) & (h_all - h >= least)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = g**2 / (h + penalty) + (g_all - g) ** 2 / (h_all - h + penalty)
        gain -= g_all**2 / (h_all + penalty)
    gain = np.where(allowed, gain, -np.inf)
    where = int(np.argmax(gain))
    return gain.ravel()[where], *divmod(where, hist_g.shape[1])


def fit_trees(x: np.ndarray, y: np.ndarray) -> Trees:
    """Gradient boosting with the logistic loss on binned statistics.

    Without rows the trees score 0.5; with labels of one kind only they score near that label.
    """
    rate = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(rate / (1 - rate)))
    nodes: dict[str, list] = {k: [] for k in ("feature", "cut", "left", "right", "value")}
    roots = []

    def leaf(value: float) -> int:
        me = len(nodes["value"])
        for key, v in (("feature", 0), ("cut", 0.0), ("left", me), ("right", me), ("value", value)):
            nodes[key].append(v)
        return me

    if len(np.unique(y)) == 2:
        cuts = [np.unique(np.quantile(c, np.arange(1, BINS) / BINS)) for c in x.T]
        binned = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T, strict=True)], 1)
        columns = np.arange(x.shape[1]) * BINS
        total = np.full(len(x), base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-total))
            grad, hess = y - p, p * (1 - p)
            roots.append(leaf(0.0))
            level = [(roots[-1], np.arange(len(x)))]
            for depth in range(DEPTH + 1):
                following = []
                for node, rows in level:
                    g, h = grad[rows], hess[rows]
                    best = (-np.inf, 0, 0)
                    if depth < DEPTH:
                        cell = (binned[rows] + columns).ravel()
                        shape = (x.shape[1], BINS)
                        wide = x.shape[1]
                        hist = [
                            np.bincount(cell, np.repeat(v, wide), shape[0] * BINS).reshape(shape)
                            for v in (g, h)
                        ]
                        best = _best_split(*hist, PENALTY, LEAF_WEIGHT)
                    if best[0] <= 1e-6:
                        value = RATE * g.sum() / (h.sum() + PENALTY)
                        nodes["value"][node] = float(value)
                        total[rows] += value
                        continue
                    _, f, b = best
                    low = binned[rows, f] <= b
                    nodes["feature"][node], nodes["cut"][node] = f, float(cuts[f][b])
                    nodes["left"][node], nodes["right"][node] = leaf(0.0), leaf(0.0)
                    following += [(nodes["left"][node], rows[low]), (nodes["right"][node], rows[~low])]
                level = following
    arrays = {k: np.array(v, np.float64 if k in ("cut", "value") else np.int64) for k, v in nodes.items()}
    return Trees(base, np.array(roots, np.int64), depth=DEPTH, **arrays)


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether the CRC-32 of the id as text leaves ``remainder``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder


def training_rows(stats: DataFrame, labels: DataFrame, label: str, rows: int) -> pd.DataFrame:
    """The documents of at most ``rows`` labels, those with the smallest hashes of their ids.

    Ids are chosen first, so no more than the sample's statistics reach the driver.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(label).alias("label"))
    known = known.where(~held_out(F.col("doc_id"), 4, 2))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return stats.join(F.broadcast(chosen), "doc_id").toPandas().sort_values("doc_id")


def score_quality(
    docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, threshold: float = THRESHOLD
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` and ``text_hash`` of every document.

    Statistics come from whole texts, are stored once, and serve training and scoring.  Labels
    are learnt from at most ``train_rows`` documents whose CRC-32 of the id mod 4 is not 2.
    Null and empty texts have zero statistics and a score like any other; rows without
    ``doc_id`` are left out, repeated rows come out as often, a doubly labelled document counts
    by its greater label.  Without labels every score is 0.5.  Only ``doc_id``, ``text`` and
    ``quality`` are read.
    """
    stats = stored(document_statistics(docs), "statistics")
    out = held_out(F.col("doc_id"), 4, 2)
    sample = training_rows(stats, labels, "quality", train_rows)
    x = np.array(sample["stats"].tolist(), np.float32).reshape(len(sample), len(STATISTICS))
    trees = fit_trees(x, sample["label"].to_numpy(float))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("stats").flatten().to_numpy(zero_copy_only=False)
            found = trees.score(flat.reshape(batch.num_rows, len(STATISTICS)))
            keys = {name: batch.column(name) for name in ("doc_id", "text_hash")}
            yield pa.record_batch(keys | {"score": pa.array(found)})

    scored = stats.mapInArrow(score, "doc_id long, text_hash long, score double")
    return scored.select(
        "doc_id",
        out.alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "text_hash",
    )


def drop_rejected(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: rows whose text the classifier rejects go, each judged by its own text.

    Rows without ``doc_id`` go too, as later stages name documents by it; repeated rows stay.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    kept = stored(score_quality(docs, labels), "scores").where("predicted = 1")
    kept = kept.select("doc_id", F.col("text_hash").alias("_text_hash")).distinct()
    keyed = docs.withColumn("_text_hash", F.xxhash64("text"))
    judged = keyed.join(kept, ["doc_id", "_text_hash"], "left_semi")
    return judged.select(*[F.col(f"`{c}`") for c in docs.columns])


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {"op7_quality": op7_quality}
SQL: dict[str, str] = {}
