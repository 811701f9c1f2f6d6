"""Conversations, vectors, components and the pipeline."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from weekloom.llm import chat, hnsw, vptree
from weekloom.llm.components import components


def chats(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns string")


def test_formats_read_back_whatever_texts_hold(spark):
    rng = random.Random(1)
    bits = ["<", "|", "im_end", "|>", "<|im_start|>", "<|im_end|>", "<|im_next|>", "\\", "\n", "n", "é", "assistant", "", " "]
    text = lambda: "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))
    rows = [
        (c, t, rng.choice(["user", "assistant", text()]), text(), "clash")
        for c in range(40)
        for t in range(rng.randint(1, 9))
    ]
    frame = chats(spark, rows)
    formatted = chat.format_chats(frame)
    read = formatted.select("conv_id", chat.read_back(F.col("formatted")).alias("turns")).collect()
    for r in read:
        want = [(role, t) for c, _, role, t, _ in rows if c == r["conv_id"]]
        assert [(t["role"], t["text"]) for t in r["turns"]] == want
    for r in chat.digests(formatted).collect():
        want = [(role, t) for c, _, role, t, _ in rows if c == r["conv_id"]]
        loss = "".join(t for role, t in want if role == "assistant")
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in want).encode()).hexdigest()
        assert (r["n_turns"], r["loss_chars"]) == (len(want), len(loss))
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


def test_adjacent_turns_share_a_block(spark):
    rows = [(1, 2, "user", "c", ""), (1, 1, "user", "b", ""), (1, 0, "system", "a", ""), (1, 3, None, None, "")]
    found = chat.format_chats(chats(spark, rows)).first()["formatted"]
    assert found == (
        "<|im_start|>system\na<|im_end|>\n<|im_start|>user\nb<|im_next|>c<|im_end|>\n<|im_start|>\n<|im_end|>\n"
    )


def test_odd_conversations(spark):
    rows = [(1, None, "user", "x", ""), (1, 0, "user", "y", ""), (1, 0, "user", "y", ""), (None, 0, "user", "z", "")]
    found = chat.format_chats(chats(spark, rows)).collect()
    assert [r["formatted"] for r in found] == ["<|im_start|>user\nx<|im_next|>y<|im_next|>y<|im_end|>\n"]
    assert chat.format_chats(chats(spark, [])).count() == 0


ODD = [
    (1001, None, 1), (1002, [0.0] * 4, 1), (1003, [1.0, None, 0.0, 0.0], 1),
    (1004, [float("nan"), 1.0, 0.0, 0.0], 1), (1005, [float("inf"), 1.0, 0.0, 0.0], 1),
    (1006, [1.0, 2.0, 3.0, 4.0], None), (None, [1.0, 2.0, 3.0, 4.0], 1), (1100, [], 1),
]


def vectors(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    return frame.selectExpr("*", "'clash' AS score", "'clash' AS points")


def cloud(seed, n=500):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(25, 4))
    points = (centres[rng.integers(0, 25, n)] + 0.05 * rng.normal(size=(n, 4))).astype(np.float32)
    points[10:20] = points[9]
    return points


@pytest.mark.parametrize("factor, recall", [(1.0, 1.0), (0.5, 0.9)])
def test_nearest_neighbours(spark, factor, recall):
    points = cloud(2)
    rows = [(i, p.tolist(), 1) for i, p in enumerate(points)] + ODD
    frame = vectors(spark, rows)
    asked = frame.where("vec_id % 10 = 0")
    found = vptree.nearest_neighbours(frame, asked, 5, factor, shard_rows=200, block_rows=20).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    exact = {i: p.astype(float) for i, p in enumerate(points)} | {1006: np.arange(1.0, 5.0)}
    hits = 0
    for q in range(0, 500, 10):
        want = sorted((math.sqrt(sum((x - y) ** 2 for x, y in zip(exact[q], v, strict=True))), i) for i, v in exact.items() if i != q)[:5]
        if factor == 1.0:
            assert [i for _, i in got[q]] == [i for _, i in want]
            assert np.allclose([s for s, _ in got[q]], [s for s, _ in want], rtol=1e-12)
        hits += len({i for _, i in want} & {i for _, i in got[q]})
    assert hits >= recall * 250
    assert set(got) == set(range(0, 500, 10))


def test_fewer_candidates_than_neighbours(spark):
    frame = vectors(spark, [(0, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (1, [0.0, 2.0], 1)])
    found = vptree.nearest_neighbours(frame, frame, 10).collect()
    assert {(r["query_id"], r["rank"], r["vec_id"]) for r in found} == {(0, 1, 1), (1, 1, 0)}
    empty = frame.limit(0)
    assert vptree.nearest_neighbours(empty, empty).count() == 0


def test_components_of_any_size_have_neighbours(spark):
    """Squares that overflow or vanish, vectors of other lengths, and distances beyond the doubles."""
    rows = [(0, [1e200, 1.0]), (1, [1e200, 2e200]), (2, [3e200, 0.0]), (3, [1e-200, 0.0]), (4, [3e-200, 0.0]),
            (5, [1.5e308, 1.5e308]), (6, [-1.5e308, -1.5e308]), (7, [1.0, 2.0, 4.0]), (8, [1.0, 2.0, 3.0]), (9, [2.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {}
    for r in sorted(vptree.nearest_neighbours(frame, frame, 10, shard_rows=3).collect(), key=lambda r: r["rank"]):
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    exact = dict(rows)
    for q, v in exact.items():
        want = sorted((math.dist(v, w), i) for i, w in exact.items() if i != q and len(w) == len(v))
        got = found.get(q, [])
        assert [i for i, _ in got] == [i for _, i in want]
        assert [s for _, s in got] == pytest.approx([d for d, _ in want], rel=1e-12)
    assert 9 not in found and found[5][-1] == (6, math.inf)


def test_links_of_components_of_any_size(spark):
    rows = [(0, [1e200, 1.0], 1), (1, [1e200, 1.0001], 1), (2, [1e-200, 1e-200], 1), (3, [2e-200, 2e-200], 1),
            (4, [5e-324, 5e-324], 1), (5, [1.7e308, 1.7e308], 1), (6, [1.0, 1.0, 0.0], 1), (7, [1.0, 1.0, 0.01], 1), (8, [1.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in hnsw.near_duplicate_vectors(frame).collect()}
    assert found == {0: (1, 0), 1: (1, 0), 2: (3, 2), 3: (3, 2), 4: (3, 2), 5: (3, 2), 6: (1, 6), 7: (1, 6), 8: (0, 8)}


def test_pruning_skips_and_bounds_hold():
    points = cloud(3, 3000).astype(float)
    ids = np.arange(len(points))
    tree = vptree.build_tree(points, ids)
    queries = points[::100]
    compared = {}
    for factor in (1.0, 0.3):
        run = vptree.Search(ids, points, ids[::100], queries, 5, factor)
        seen = []
        offer = run.offer
        run.offer = lambda who, rows, offer=offer, seen=seen: (seen.append(len(who) * len(rows)), offer(who, rows))[1]
        run.walk(tree, np.arange(len(queries)))
        compared[factor] = sum(seen)
    assert compared[0.3] < compared[1.0] < len(points) * len(queries)


@pytest.mark.parametrize("shard, block", [(60, 40), (8192, 2048)])
def test_vector_groups_equal_brute_force(spark, monkeypatch, shard, block):
    defaults = hnsw.shard_links.__defaults__
    monkeypatch.setattr(hnsw.shard_links, "__defaults__", (defaults[0], shard, block))
    points = cloud(4, 400)
    label = [i % 2 for i in range(400)]
    rows = [(i, p.tolist(), label[i]) for i, p in enumerate(points)] + ODD
    found = {r["vec_id"]: r for r in hnsw.near_duplicate_vectors(vectors(spark, rows)).collect()}
    exact = points.astype(float)
    unit = exact / np.linalg.norm(exact, axis=1, keepdims=True)
    link = (unit @ unit.T >= 0.98) & (np.equal.outer(label, label)) & ~np.eye(400, dtype=bool)
    assert link.sum() > 1000
    root = list(range(400))
    changed = True
    while changed:
        changed = False
        for i in range(400):
            low = min([root[i], *[root[j] for j in np.flatnonzero(link[i])]])
            changed |= low != root[i]
            root[i] = low
    for i in range(400):
        assert (found[i]["n_links"], found[i]["component_id"]) == (link[i].sum(), root[i])
        assert found[i]["kept"] == (root[i] == i)
    for i, *_ in ODD:
        if i:
            assert (found[i]["n_links"], found[i]["component_id"], found[i]["kept"]) == (0, i, True)
    assert hnsw.near_duplicate_vectors(vectors(spark, [])).count() == 0


def test_beams_widen_for_a_large_group(spark):
    rng = np.random.default_rng(5)
    points = (np.ones((300, 4)) + 0.001 * rng.normal(size=(300, 4))).astype(np.float32)
    frame = vectors(spark, [(i, p.tolist(), 1) for i, p in enumerate(points)])
    found = hnsw.near_duplicate_vectors(frame).collect()
    assert {(r["n_links"], r["component_id"]) for r in found} == {(299, 0)}


def test_links_across_shards_equal_brute_force(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(100, 64))  # a cluster has about 40 rows in each of three shards
    points = centres[rng.integers(0, 100, 12_000)] + 0.33 * rng.normal(size=(12_000, 64))
    points[6_000:6_400] = points[:400] + 0.05 * rng.normal(size=(400, 64))
    points = points.astype(np.float32)
    unit = points.astype(float) / np.linalg.norm(points.astype(float), axis=1, keepdims=True)
    want = {}
    for at in range(0, 12_000, 1_000):
        link = unit[at : at + 1_000] @ unit.T >= 0.98
        want |= {at + i: int(n) - 1 for i, n in enumerate(link.sum(axis=1))}
    assert 800 <= sum(want.values()) < 2_000
    found = hnsw.near_duplicate_vectors(vectors(spark, [(i, p.tolist(), 1) for i, p in enumerate(points)])).collect()
    assert {r["vec_id"]: r["n_links"] for r in found} == want


@pytest.mark.parametrize("evidence", [20, 10**9])
def test_beams_take_over_on_evidence_only(monkeypatch, evidence):
    rng = np.random.default_rng(9)
    centres = np.repeat(rng.normal(size=(500, 16)), 4, axis=0)
    unit = hnsw._unit(centres + 0.02 * rng.normal(size=centres.shape))
    asked = []
    within = hnsw.Graph.within
    monkeypatch.setattr(hnsw.Graph, "within", lambda *a: (asked.append(len(a[1])), within(*a))[1])
    for own in (np.arange(2000), np.full(2000, -1)):
        row, hit = hnsw.Graph(unit).links_of(unit, own, 0.98, evidence)
        want = {(int(a), int(b)) for a, b in zip(*np.nonzero(unit @ unit.T >= 0.98 - 1e-5), strict=True) if own[a] != b}
        got = set(zip(row.tolist(), hit.tolist(), strict=True))
        assert len(got) == len(row) and got <= want and len(got) >= 0.99 * len(want)
        assert evidence == 20 or got == want
    assert bool(asked) == (evidence == 20)
    asked.clear()
    one = hnsw._unit(np.ones((500, 16)) + 0.001 * rng.normal(size=(500, 16)))  # one group is no evidence of others
    row, _ = hnsw.Graph(one).links_of(one, np.arange(500), 0.98, 20)
    assert len(row) == 500 * 499 and not asked


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(6)
    chain = list(range(100, 160))
    order = list(range(59))
    rng.shuffle(order)
    edges = [(chain[i], chain[i + 1]) for i in order]
    edges += [(7, i) for i in range(200, 400)] + [(7, 7), (8, None), (500, 300), (900, 901), (901, 900)]
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    got = {r["node"]: r["component"] for r in found}
    assert all(got[i] == 100 for i in chain)
    assert all(got[i] == 7 for i in [7, 500, *range(200, 400)])
    assert (got[900], got[901]) == (900, 900) and 8 not in got
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline_stages_chain(spark):
    folder = "/root/testdata/sf0.001"
    docs = given = spark.read.parquet(f"{folder}/documents.parquet")
    sizes = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == given.columns
        sizes.append(docs.count())
    assert sizes[1] <= sizes[0] <= given.count() and sizes[2] == sizes[1]
    out = corpus_pipeline.run(spark, folder).collect()
    assert len(out) == sizes[3]
    assert all(r["exact"] and r["n_tokens"] == len(r["ids"]) for r in out)


def test_quality_stage_keeps_clean_documents(spark):
    folder = "/root/testdata/sf0.01"
    given = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    kept = corpus_pipeline.STAGES[0][1](spark, given, folder).select("doc_id")
    good = labels.where("quality = 1")
    assert good.join(kept, "doc_id").count() >= 0.95 * good.count()
