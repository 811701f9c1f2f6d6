"""Embedding near-duplicates by navigable small-world graphs over shards of the vectors.

A beam is trusted for a block of queries only after enough of the block's links were counted by
brute force and found by the beam; where links are too few for that, brute force counts them all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.llm.components import components
from weekloom.llm.storage import stored
from weekloom.llm.vptree import usable

THRESHOLD = 0.98
#: Vectors of a shard, and vectors of a block of queries, on average.
SHARD_ROWS, BLOCK_ROWS = 4_096, 2_048
#: Links of a node in one direction; the lowest layer has twice as many.
LINKS = 12
#: First width of the beam, and queries counted by brute force at once.
BEAM, AUDIT = 16, 128
#: Groups of linked vectors an audit must have met: with none missed of 300, less than 1 % are
#: missed, at a confidence of 95 %.
EVIDENCE = 300
#: Nodes of the layer above from which a beam starts.
ENTRIES = 4
#: How far below the threshold a wider beam follows links, more with each widening.
FLOOR_STEP = 0.01
#: Share of the audited links a beam must find.
RECALL = 1.0


@dataclass(frozen=True)
class Layer:
    members: np.ndarray  # numbers of the nodes of this layer
    links: np.ndarray  # nodes x links: numbers of neighbours, or -1


def _neighbours(unit: np.ndarray, members: np.ndarray, links: int) -> np.ndarray:
    """Links of the members of a layer: of the nearest, those nearer to the node than to a
    neighbour already taken, then links back from those neighbours while there is room."""
    n = len(members)
    wide = min(n - 1, 3 * links)
    out = np.full((len(unit), 2 * links), -1, np.int64)
    if wide <= 0:
        return out
    vectors = unit[members]
    for at in range(0, n, 512):
        near = vectors[at : at + 512] @ vectors.T
        near[np.arange(len(near)), np.arange(at, at + len(near))] = -np.inf
        candidates = np.argpartition(-near, wide - 1, axis=1)[:, :wide]
        close = np.take_along_axis(near, candidates, 1)
        order = np.argsort(-close, axis=1, kind="stable")
        candidates = np.take_along_axis(candidates, order, 1)
        close = np.take_along_axis(close, order, 1)
        among = np.einsum("nij,nkj->nik", vectors[candidates], vectors[candidates])
        taken = np.zeros(close.shape, bool)
        for j in range(wide):
            blocked = (taken[:, :j] & (among[:, j, :j] > close[:, j, None])).any(axis=1)
            taken[:, j] = ~blocked & (taken.sum(axis=1) < links)
        for j in range(wide):  # places left over go to the nearest of the others
            taken[:, j] |= taken.sum(axis=1) < links // 2
        node, place = np.nonzero(taken)
        slot = np.cumsum(taken, axis=1)[node, place] - 1
        out[members[at + node], slot] = members[candidates[node, place]]
    node, slot = np.nonzero(out >= 0)
    source, target = node, out[node, slot]
    size = np.int64(len(unit))
    fresh = ~np.isin(target * size + source, source * size + target)  # not linked already
    source, target = source[fresh], target[fresh]
    room = (out >= 0).sum(axis=1)
    order = np.argsort(target, kind="stable")
    target, source = target[order], source[order]
    inner = np.arange(len(target)) - np.searchsorted(target, target)
    slot = room[target] + inner
    fits = slot < 2 * links
    out[target[fits], slot[fits]] = source[fits]
    return out


class Graph:
    """A hierarchical graph over the unit vectors of one shard.

    The level of a node is geometric in a hash of its id.  Within a shard the nearest nodes of a
    layer are found by blocked products, so the graph doesn't depend on an order of insertion.
    """

    def __init__(self, unit: np.ndarray):
        self.unit = unit

    @cached_property
    def layers(self) -> list[Layer]:
        """Built when a beam first asks for them."""
        n = len(self.unit)
        draws = np.random.default_rng(n).random(n)
        level = np.floor(-np.log(np.maximum(draws, 1e-12)) / math.log(LINKS)).astype(int)
        level[np.argmax(level)] = level.max(initial=0)
        layers = []
        for k in range(int(level.max(initial=0)) + 1):
            members = np.flatnonzero(level >= k)
            layers.append(Layer(members, _neighbours(self.unit, members, LINKS)))
        return layers

    def descend(self, queries: np.ndarray) -> np.ndarray:
        """The nodes each query enters the lowest layer at: the ENTRIES nearest of those a beam
        meets in the layers above, which it walks from the top.  -1 stands for a place not filled."""
        at = np.broadcast_to(self.layers[-1].members[:1], (len(queries), 1))
        for layer in self.layers[:0:-1]:
            at, _ = self.walk(layer.links, queries, at, ENTRIES)
        return at

    def beam(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` best nodes each query meets in the lowest layer: numbers and cosines."""
        return self.walk(self.layers[0].links, queries, self.descend(queries), width)

    def walk(
        self, links: np.ndarray, queries: np.ndarray, entry: np.ndarray, width: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` best nodes each query meets in one layer from its entries on.

        The links of the best node not yet left are followed until none is fresh.
        """
        n = len(self.unit)
        width = min(width, n)
        q = np.arange(len(queries))
        nodes = np.full((len(queries), width), -1, np.int64)
        near = np.full((len(queries), width), -np.inf, np.float32)
        fresh = np.zeros((len(queries), width), bool)
        entry = entry[:, :width]
        entries, known = entry.shape[1], entry >= 0
        nodes[:, :entries], fresh[:, :entries] = entry, known
        value = np.einsum("qd,qed->qe", queries, self.unit[entry])
        near[:, :entries] = np.where(known, value, -np.inf)
        seen = np.zeros((len(queries), n), bool)
        row, col = np.nonzero(known)
        seen[row, entry[row, col]] = True
        active = q
        while len(active):
            order = np.where(fresh[active], near[active], -np.inf)
            pick = order.argmax(axis=1)
            alive = fresh[active, pick]
            active, pick = active[alive], pick[alive]
            if not len(active):
                break
            fresh[active, pick] = False
            around = links[nodes[active, pick]]
            new = (around >= 0) & ~seen[active[:, None], around]
            rows, cols = np.nonzero(new)
            seen[active[rows], around[rows, cols]] = True
            value = np.full(around.shape, -np.inf, np.float32)
            value[rows, cols] = np.einsum(
                "rd,rd->r", queries[active[rows]], self.unit[around[rows, cols]]
            )
            all_near = np.concatenate([near[active], value], 1)
            all_nodes = np.concatenate([nodes[active], around], 1)
            all_fresh = np.concatenate([fresh[active], new], 1)
            keep = np.argpartition(-all_near, width - 1, axis=1)[:, :width]
            near[active] = np.take_along_axis(all_near, keep, 1)
            nodes[active] = np.take_along_axis(all_nodes, keep, 1)
            fresh[active] = np.take_along_axis(all_fresh, keep, 1) & np.isfinite(near[active])
        return nodes, near

    def within(self, queries: np.ndarray, width: int, low: float, floor: float):
        """Pairs (query, node) at or above ``low``: a beam finds the neighbourhood, from where all
        nodes at or above ``floor`` are followed along their links, however many there are."""
        links = self.layers[0].links
        nodes, near = self.beam(queries, width)
        row, col = np.nonzero(near >= floor)
        # a beam can hold a node twice
        _, once = np.unique(row * len(self.unit) + nodes[row, col], return_index=True)
        row, col = row[once], col[once]
        front, value = nodes[row, col], near[row, col]
        seen = np.zeros((len(queries), len(self.unit)), bool)
        seen[row, front] = True
        rows, hits = [row[value >= low]], [front[value >= low]]
        while len(front):
            around = links[front]
            owner = np.repeat(row, around.shape[1])
            around = around.ravel()
            new = around >= 0
            new[new] = ~seen[owner[new], around[new]]
            pairs = np.unique(owner[new] * len(self.unit) + around[new])
            row, front = np.divmod(pairs, len(self.unit))
            seen[row, front] = True
            value = np.concatenate(
                [np.zeros(0, np.float32)]
                + [
                    np.einsum("rd,rd->r", queries[row[at : at + 65536]], self.unit[front[at : at + 65536]])
                    for at in range(0, len(row), 65536)
                ]
            )
            rows.append(row[value >= low])
            hits.append(front[value >= low])
            row, front = row[value >= floor], front[value >= floor]
        return np.concatenate(rows), np.concatenate(hits)

    def links_of(
        self, queries: np.ndarray, own: np.ndarray, threshold: float, evidence: int = EVIDENCE
    ) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, node) at or above ``threshold`` (less rounding); ``own`` is each query's
        number in the shard, which is no link of its own, or -1.

        Queries are counted by brute force in a random order until their links lie in ``evidence``
        groups, each known by its least node: a large group counts once.  The others then go to
        the first beam that finds RECALL of the links counted, each twice as wide as the one
        before and with a lower floor.  Without evidence, or without such a beam narrower than
        the shard, brute force goes on to the last query.
        """
        low = threshold - 1e-5  # single precision
        order = np.random.default_rng(len(queries)).permutation(len(queries))

        def others(which, row, hit):
            keep = own[which[row]] != hit
            return which[row[keep]], hit[keep]

        rows, hits, groups, beams = [], [], np.zeros(0, np.int64), True
        for at in range(0, len(order), AUDIT):
            part = order[at : at + AUDIT]
            row, hit = np.nonzero(queries[part] @ self.unit.T >= low)
            first = np.unique(row, return_index=True)[1]  # the least hit of each query, or itself
            alone = np.bincount(row, minlength=len(part))[row[first]] <= (own[part[row[first]]] >= 0)
            groups = np.union1d(groups, hit[first[~alone]])
            for found, new in zip((rows, hits), others(part, row, hit), strict=True):
                found.append(new)
            if not beams or len(groups) < evidence:
                continue
            seen, rest = order[: at + AUDIT], order[at + AUDIT :]
            truth = sum(map(len, rows))
            width, floor = BEAM, low
            while width < len(self.unit):
                met = others(seen, *self.within(queries[seen], width, low, floor))
                if len(met[0]) >= RECALL * truth:
                    row, hit = others(rest, *self.within(queries[rest], width, low, floor))
                    return np.concatenate([*rows, row]), np.concatenate([*hits, hit])
                width, floor = 2 * width, floor - FLOOR_STEP
            beams = False
        return np.concatenate(rows), np.concatenate(hits)


def evened(vectors: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, so that the largest component is from 0.5 to 1.

    Nothing is rounded but components too small to count, and no product overflows or vanishes.
    """
    _, power = np.frexp(np.abs(vectors).max(axis=1, initial=0.0))
    return np.ldexp(vectors, -power[:, None])


def exact_cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of rows in double precision, summed in the order of the components."""
    a, b = evened(a), evened(b)
    dot, aa, bb = np.zeros(len(a)), np.zeros(len(a)), np.zeros(len(a))
    for j in range(a.shape[1]):
        dot += a[:, j] * b[:, j]
        aa += a[:, j] * a[:, j]
        bb += b[:, j] * b[:, j]
    return dot / np.sqrt(aa * bb)


def star_edges(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each node to the least node it is connected with by the given edges."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = ends[: len(a)], ends[len(a) :]
    least = np.arange(len(nodes))
    while True:
        before = least.copy()
        low = np.minimum(least[u], least[v])
        np.minimum.at(least, u, low)
        np.minimum.at(least, v, low)
        least = least[least]
        if (least == before).all():
            moved = least != np.arange(len(nodes))
            return nodes[moved], nodes[least[moved]]


def _unpacked(rows: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, vectors and numbers of copies of a packed group."""
    ids, vectors, copies = rows.flatten()
    ids = ids.to_numpy(zero_copy_only=False)
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    return ids, values.reshape(len(ids), -1), copies.to_numpy(zero_copy_only=False)


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = evened(vectors)
    return (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)


def shard_links(
    classes: DataFrame,
    threshold: float = THRESHOLD,
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Links within equal labels at a cosine of ``threshold`` or more, summed up where found.

    ``classes`` has ``vec_id``, ``label``, ``embedding`` (doubles) and ``copies``, vectors all different.  Each label's
    vectors are dealt to shards by a hash of the id, as many as its size needs; a block of
    vectors queries every shard of its label, and what it meets is verified by
    :func:`exact_cosine`.  Rows (a, b, others): with b null, ``others`` is the number of vectors of
    one shard linked to a; otherwise a and b are connected by links of one visit.  So a group
    of many near copies leaves a row for each of them, not for each pair.
    """
    classes = classes.withColumn("dim", F.size("embedding"))
    sizes = classes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("rows"))
    sizes = sizes.select(
        "label",
        "dim",
        F.ceil(F.col("rows") / F.lit(shard_rows)).cast("int").alias("shards"),
        F.ceil(F.col("rows") / F.lit(block_rows)).cast("int").alias("blocks"),
    )
    dealt = classes.join(sizes, ["label", "dim"])
    place = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
    packed = F.sort_array(F.collect_list(F.struct("vec_id", "embedding", "copies")))
    # one row holds a shard or a block of bounded size
    index = dealt.groupBy("label", "dim", place("shards").alias("shard")).agg(packed.alias("points"))
    blocks = dealt.groupBy("label", "dim", "shards", place("blocks").alias("block"))
    blocks = blocks.agg(packed.alias("asked"))
    visits = blocks.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    pairs = visits.join(index, ["label", "dim", "shard"])
    pairs = pairs.select("label", "dim", "shard", "points", "asked")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, graph = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                now = tuple(batch.column(c)[i].as_py() for c in ("label", "dim", "shard"))
                if now != key:
                    key = now
                    ids, points, copies = _unpacked(batch.column("points")[i].values)
                    graph = Graph(_unit(points))
                asked_ids, asked, _ = _unpacked(batch.column("asked")[i].values)
                own = np.minimum(np.searchsorted(ids, asked_ids), len(ids) - 1)
                own = np.where(ids[own] == asked_ids, own, -1)
                rows, hits = graph.links_of(_unit(asked), own, threshold)
                sure = np.zeros(len(rows), bool)
                for at in range(0, len(rows), 1 << 16):
                    part = slice(at, at + (1 << 16))
                    sure[part] = exact_cosine(asked[rows[part]], points[hits[part]]) >= threshold
                rows, hits = rows[sure], hits[sure]
                others = np.bincount(rows, copies[hits], len(asked_ids)).astype(np.int64)
                met = np.flatnonzero(others)
                a, b = star_edges(asked_ids[rows], ids[hits])
                nodes = np.concatenate([asked_ids[met], a])
                counts = np.concatenate([others[met], np.zeros(len(a), np.int64)])
                ends = np.concatenate([np.zeros(len(met), np.int64), b])
                edge = np.arange(len(nodes)) >= len(met)
                yield pa.record_batch(
                    {
                        "a": pa.array(nodes),
                        "b": pa.array(ends, mask=~edge),
                        "others": pa.array(counts, mask=edge),
                    }
                )

    return pairs.mapInArrow(link, "a long, b long, others long")


def near_duplicate_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` for every row of ``vectors``.

    Rows are linked where labels are equal and not null and the cosine is ``threshold`` or more;
    vectors of different lengths have none.  Vectors are scaled before they are multiplied, so finite
    components of any size count.
    Equal vectors of one label are one class, of which only the smallest ``vec_id`` searches;
    its links count for each copy.  Unusable vectors and those without label have no link and
    are components of their own.  Rows without ``vec_id`` are left out; rows that repeat an id
    come out as often, the id's smallest usable (label, vector) counting.  An empty table gives
    an empty result.
    """
    rows = vectors.where("vec_id IS NOT NULL").select(F.col("vec_id").cast("long"))
    labelled = usable(vectors).where("label IS NOT NULL")
    double = F.col("embedding").cast("array<double>").alias("embedding")
    points = labelled.select(F.col("vec_id").cast("long"), "label", double)
    least = F.min(F.struct("label", "embedding")).alias("p")
    points = stored(points.groupBy("vec_id").agg(least).select("vec_id", "p.*"), "points")
    classes = points.groupBy("label", "embedding").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")
    )
    classes = stored(classes, "classes")
    searched = classes.select(F.col("rep").alias("vec_id"), "label", "embedding", "copies")
    found = stored(shard_links(searched, threshold), "links")
    links = found.where("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("others").alias("others"))
    edges = found.where("b IS NOT NULL").select("a", "b")
    groups = components(edges).select(F.col("node").alias("rep"), "component")
    known = classes.join(links, "rep", "left").join(groups, "rep", "left").select(
        "label",
        "embedding",
        (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    found = points.join(known, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    out = rows.join(found, "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )


def op10_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {"op10_hnsw": op10_hnsw}

_USABLE = """
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0"""

SQL = {
    "op10_hnsw": f"""
WITH RECURSIVE usable AS ({_USABLE}),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
  ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= {THRESHOLD}),
reached(node, other) AS (
  SELECT vec_id, vec_id FROM usable
  UNION SELECT r.node, l.b FROM reached r JOIN links l ON r.other = l.a),
least AS (SELECT node, min(other) AS component_id FROM reached GROUP BY node),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0)::BIGINT AS n_links,
  coalesce(l.component_id, e.vec_id) AS component_id,
  e.vec_id = coalesce(l.component_id, e.vec_id) AS kept
FROM embeddings e LEFT JOIN counted c ON e.vec_id = c.a LEFT JOIN least l ON e.vec_id = l.node
WHERE e.vec_id IS NOT NULL
"""
}
