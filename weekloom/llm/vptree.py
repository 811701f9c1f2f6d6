"""Approximate nearest neighbours: vantage-point trees over shards of the vectors."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weekloom.llm.storage import stored

#: Vectors of a shard, and queries of a block, on average.
SHARD_ROWS, BLOCK_ROWS = 4_096, 512
LEAF_ROWS = 128
#: Stands for a neighbour not found.
NOBODY = np.iinfo(np.int64).max
#: Sums of squares outside are taken again with scaled components, as some squares may be no doubles.
SQUARES = (2.0**-900, 2.0**1000)
NEIGHBOURS = 10
#: 1: exact search; smaller factors prune earlier and may miss neighbours.
FACTOR = 1.0


def usable(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """Rows with an id and a vector that is not null, zero, or holding null or non-finite parts."""
    parts = F.col(column)
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    fine = ~F.exists(parts, bad) & F.exists(parts, lambda x: x != 0)
    return vectors.where(F.col(id_column).isNotNull() & F.coalesce(fine, F.lit(False)))


def distances(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, squares summed in the order of the components.

    Where squares overflow or vanish, the gaps are first multiplied by a power of two, which changes
    no digit; a distance is infinite only if it is greater than every double.
    """
    with np.errstate(over="ignore", under="ignore"):
        total = np.zeros((len(queries), len(points)))
        for j in range(points.shape[1]):
            gap = queries[:, j, None] - points[None, :, j]
            total += gap * gap
        found = np.sqrt(total)
        q, p = np.nonzero(~((total > SQUARES[0]) & (total < SQUARES[1])))
        for at in range(0, len(q), 1 << 14):
            some = slice(at, at + (1 << 14))
            left, right = queries[q[some]], points[p[some]]
            # halves where the gap between two doubles is none
            gaps, half = left - right, np.zeros(len(left), int)
            wide = ~np.isfinite(gaps).all(axis=1)
            gaps[wide], half[wide] = left[wide] / 2 - right[wide] / 2, 1
            _, power = np.frexp(np.abs(gaps).max(axis=1, initial=0.0))
            gaps = np.ldexp(gaps, -power[:, None])
            squares = np.zeros(len(gaps))
            for j in range(gaps.shape[1]):
                squares += gaps[:, j] * gaps[:, j]
            found[q[some], p[some]] = np.ldexp(np.sqrt(squares), power + half)
    return found


@dataclass
class Node:
    """A vantage point with its ball, or a leaf of points (numbers into the shard's arrays)."""

    vantage: int = -1
    inner: tuple[float, float] = (0.0, 0.0)  # least and greatest distance inside the ball
    outer: tuple[float, float] = (0.0, 0.0)
    children: list[Node] = field(default_factory=list)
    rows: np.ndarray | None = None


def build_tree(points: np.ndarray, rows: np.ndarray) -> Node:
    """Halve the points by their distance to a vantage point until LEAF_ROWS are left.

    The vantage point is the one farthest from the first row.  Points all equally far away, as
    copies are, stay together in one leaf.
    """
    if len(rows) <= LEAF_ROWS:
        return Node(rows=rows)
    start = distances(points[rows[:1]], points[rows])[0]
    vantage = int(rows[np.argmax(start)])
    rest = rows[rows != vantage]
    far = distances(points[vantage : vantage + 1], points[rest])[0]
    cut = float(np.median(far))
    inside = far <= cut
    if inside.all():
        inside = far < cut
    if not inside.any() or inside.all():
        return Node(rows=rows)
    return Node(
        vantage,
        (float(far[inside].min()), float(far[inside].max())),
        (float(far[~inside].min()), float(far[~inside].max())),
        [build_tree(points, rest[inside]), build_tree(points, rest[~inside])],
    )


class Search:
    """The nearest points of one shard to a block of queries, all walking the tree together."""

    def __init__(self, ids, points, query_ids, queries, k, factor):
        self.ids, self.points, self.query_ids, self.queries = ids, points, query_ids, queries
        self.k, self.factor = k, factor
        self.best = np.full((len(queries), k), np.inf)
        self.found = np.full((len(queries), k), NOBODY)

    def offer(self, who: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Compare queries ``who`` with points ``rows``; ties go to the smaller id."""
        near = distances(self.queries[who], self.points[rows])
        ids = np.broadcast_to(self.ids[rows], near.shape)
        own = ids == self.query_ids[who, None]
        all_near = np.concatenate([self.best[who], np.where(own, np.inf, near)], 1)
        all_ids = np.concatenate([self.found[who], np.where(own, NOBODY, ids)], 1)
        order = np.lexsort((all_ids, all_near), axis=1)[:, : self.k]
        self.best[who] = np.take_along_axis(all_near, order, 1)
        self.found[who] = np.take_along_axis(all_ids, order, 1)
        return near

    def walk(self, node: Node, who: np.ndarray) -> None:
        if len(who) == 0:
            return
        if node.rows is not None:
            self.offer(who, node.rows)
            return
        to = self.offer(who, np.array([node.vantage]))[:, 0]
        # By the triangle inequality no point of a side is nearer than this.
        with np.errstate(invalid="ignore"):  # between infinite distances there is no bound
            least = [np.fmax(np.fmax(lo - to, to - hi), 0) for lo, hi in (node.inner, node.outer)]
        first = (least[1] < least[0]).astype(int)
        for turn in (0, 1):
            side = first if turn == 0 else 1 - first
            for child in (0, 1):
                pick = side == child
                bound = least[child][pick]
                # rounding may lift a bound by some units in the last place
                slack = 1e-9 * (1 + to[pick])
                with np.errstate(invalid="ignore"):
                    reach = ~(bound - slack > self.factor * self.best[who[pick], self.k - 1])
                self.walk(node.children[child], who[pick][reach])


def _matrix(rows: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of a packed group."""
    flat = rows.flatten()
    ids = flat[0].to_numpy(zero_copy_only=False)
    values = flat[1].flatten().to_numpy(zero_copy_only=False)
    return ids, values.reshape(len(ids), -1)


def nearest_neighbours(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = NEIGHBOURS,
    factor: float = FACTOR,
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The ``k`` nearest rows of ``vectors`` to each row of ``queries`` by Euclidean distance.

    Both have ``vec_id`` and ``embedding``; a row is not its own neighbour.  Rows come out as
    ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``, nearest first, ties to the smaller id; all
    candidates if there are fewer than ``k``.  A query without other vectors has no rows.

    Vectors are dealt to shards by a hash of the id, each with a tree of its own; each block of
    queries visits each shard, and the best of all shards are ranked.  A side of a vantage
    point is skipped if its distance bound exceeds ``factor`` times the k-th distance so far:
    1 gives the exact result.  Unusable vectors (:func:`usable`) take part in neither table; of
    rows with one id the smallest vector counts.  A vector's neighbours are those of its own length; finite
    components of any size are compared, and distances beyond the greatest double come last, as infinite.
    """

    def prepared(df: DataFrame) -> DataFrame:
        double = F.col("embedding").cast("array<double>")
        rows = usable(df).select(F.col("vec_id").cast("long"), double.alias("embedding"))
        return rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))

    points = stored(prepared(vectors), "vectors")
    asked = stored(prepared(queries), "queries")
    shards = max(1, math.ceil(points.count() / shard_rows))
    parts = max(1, math.ceil(asked.count() / block_rows))
    place = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    packed = F.sort_array(F.collect_list(F.struct("vec_id", "embedding")))
    # one row holds a shard or a block of bounded size
    dim = F.size("embedding").alias("dim")
    index = points.groupBy(dim, place(shards).alias("shard")).agg(packed.alias("points"))
    blocks = asked.groupBy(dim, place(parts).alias("block")).agg(packed.alias("asked"))
    visits = blocks.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    pairs = visits.repartition(shards, "shard").join(index.hint("shuffle_hash"), ["shard", "dim"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tree = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                now = batch.column("shard")[i].as_py(), batch.column("dim")[i].as_py()
                if now != held:
                    held = now
                    ids, matrix = _matrix(batch.column("points")[i].values)
                    tree = build_tree(matrix, np.arange(len(ids)))
                query_ids, asked_for = _matrix(batch.column("asked")[i].values)
                run = Search(ids, matrix, query_ids, asked_for, k, factor)
                run.walk(tree, np.arange(len(query_ids)))
                hit = run.found != NOBODY
                yield pa.record_batch(
                    {
                        "query_id": pa.array(np.repeat(query_ids, hit.sum(axis=1))),
                        "vec_id": pa.array(run.found[hit]),
                        "score": pa.array(run.best[hit]),
                    }
                )

    visits = pairs.select("shard", "dim", "points", "asked")
    found = visits.mapInArrow(search, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op3_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest_neighbours(vectors, vectors.where("vec_id % 100 = 0"))


QUERIES = {"op3_vptree": op3_vptree}

SQL = {
    "op3_vptree": f"""
WITH usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_sum(list_transform(list_zip(q.v, c.v),
    lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS score
  FROM usable q JOIN usable c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id))::INT AS rank,
  vec_id, score
FROM scored
QUALIFY rank <= {NEIGHBOURS}
"""
}
