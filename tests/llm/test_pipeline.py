"""The pipeline against a plain chain of its stages, and its stages on odd rows."""

import hashlib
from collections import Counter

import duckdb
import pandas as pd
import pytest
import sentencepiece

import corpus_pipeline
from test_texts import plain_groups, plain_removal
from weekloom.llm import mixing, pieces, quality, simhash

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)
FIELDS = "doc_id long, text string, lang string, source string, n_chars long"


def plain_chain(spark, docs, labels):
    """(doc_id, ids_sha256) with their numbers; only the trees' scores and the mixing SQL are taken as given."""
    scores = quality.score_quality(spark.createDataFrame(docs), labels).where("predicted = 1")
    good = {r["doc_id"] for r in scores.collect()}
    kept = docs[docs["doc_id"].isin(good)]
    points = {int(i): simhash.fingerprint(t) % 2**64 for i, t in zip(kept["doc_id"], kept["text"], strict=True)}
    near = lambda a, b: bin(points[a] ^ points[b]).count("1") <= simhash.MAX_DISTANCE
    groups = plain_groups(points, near)
    kept = kept[[groups[i] == i for i in kept["doc_id"]]]
    left = plain_removal([(int(i), t.encode()) for i, t in zip(kept["doc_id"], kept["text"], strict=True)])
    kept = kept.assign(text=[left[i][0].decode(errors="replace") for i in kept["doc_id"]])
    con = duckdb.connect()
    con.register("documents", kept)
    counts = Counter(r[0] for r in con.execute(f"SELECT doc_id FROM ({mixing.SQL['op5_mix_sources']})").fetchall())
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    out = Counter()
    for doc_id, text in zip(kept["doc_id"], kept["text"], strict=True):
        raw = b"".join(i.to_bytes(4, "little") for i in model.encode(text))
        out[int(doc_id), hashlib.sha256(raw).hexdigest()] += counts[doc_id]
    return +out


def test_rows_equal_a_plain_chain(spark, tmp_path):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    found = corpus_pipeline.run(spark, SF).collect()
    expected = plain_chain(spark, docs, labels)
    assert len({doc for doc, _ in expected}) < len(docs)
    assert Counter((r["doc_id"], r["ids_sha256"]) for r in found) == expected


def rows_of(frame):
    return sorted((tuple(r)[:2] for r in frame.collect()), key=str)


def test_rows_of_one_id_are_judged_by_their_own_text(spark):
    folder = "/root/testdata/sf0.01"
    given = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    judged = quality.score_quality(given, labels).join(given, "doc_id").where("held_out").collect()
    good, bad = (next(r for r in judged if r["predicted"] == p) for p in (1, 0))
    more = [(good["doc_id"], bad["text"], "en", "s", 1), (bad["doc_id"], good["text"], "en", "s", 1),
            (None, good["text"], "en", "s", 1)]
    frame = given.select(*(f.split()[0] for f in FIELDS.split(", "))).union(spark.createDataFrame(more, FIELDS))
    kept = Counter(rows_of(STAGES["quality classifier"](spark, frame, folder)))
    assert kept[good["doc_id"], good["text"]] == kept[bad["doc_id"], good["text"]] == 1
    assert kept[good["doc_id"], bad["text"]] == kept[bad["doc_id"], bad["text"]] == 0
    assert all(doc_id is not None for doc_id, _ in kept)


def test_one_row_of_equal_ones_stays(spark):
    words = " ".join(f"word{i}" for i in range(60))
    other = " ".join(f"other{i}" for i in range(60))
    data = [(3, words), (3, words), (3, words), (4, words), (3, other), (2, other), (7, None), (7, ""), (None, words)]
    frame = spark.createDataFrame([(i, t, "en", f"s{n}", 1) for n, (i, t) in enumerate(data)], FIELDS)
    kept = STAGES["SimHash near-dedup"](spark, frame, SF)
    assert kept.columns == frame.columns
    found = rows_of(kept)
    assert found[:2] == [(2, other), (3, words)] and len(found) == 3 and found[2][0] == 7


def test_an_empty_row_does_not_displace_a_text(spark):
    frame = spark.createDataFrame([(5, None, "en", "s", 0), (5, "real text", "en", "s", 9), (5, "", "en", "s", 0)], FIELDS)
    assert rows_of(STAGES["suffix-array dedup"](spark, frame, SF)) == [(5, "real text")]


@pytest.mark.parametrize("kind", ["empty", "odd", "clashing"])
def test_odd_tables_pass_all_stages(spark, tmp_path, kind):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "a b", "en", "s", 3), (None, "x", "en", None, 1),
            (4, "é" * 30_000, "fr", "t", 30_000), (5, "a b c", "en", "s", 5), (5, "a b c", "en", "s", 5)]
    frame = spark.createDataFrame([] if kind == "empty" else rows, FIELDS)
    if kind == "clashing":
        frame = frame.selectExpr("*", "'x' AS score", "'y' AS row", "'z' AS text_hash", "'w' AS copy2")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() >= 0
    docs = frame
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == frame.columns, name
