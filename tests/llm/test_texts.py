"""Operators on texts against brute force on small documents."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
import xxhash

from weekloom.llm import language, mixing, pieces, quality, repeats, simhash, texts, toxicity

ODD = [(1, None), (2, ""), (3, "   \n"), (4, "a"), (4, "a"), (None, "lost"), (5, "١٢ …"), (6, "é" * 30_000), (7, "x y " * 5_000)]


def noise(rng, n, letters="ab cdé"):
    return "".join(rng.choice(letters) for _ in range(n))


# --- quality -------------------------------------------------------------------------------


def quality_labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_quality_learns_a_separable_rule(spark, docs):
    rng = random.Random(0)
    rows = [(i, noise(rng, 80) if i % 2 else "### $$ " * 12) for i in range(400)]
    labels = quality_labels(spark, [(i, i % 2, 0) for i in range(400)])
    found = quality.score_quality(docs(rows), labels).collect()
    assert len(found) == 400
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert r["predicted"] == (r["score"] >= 0.7) == r["doc_id"] % 2


def test_quality_of_odd_rows_and_without_labels(spark, docs):
    labels = quality_labels(spark, [])
    found = quality.score_quality(docs(ODD, stats="clash", score="clash"), labels).collect()
    assert sorted(r["doc_id"] for r in found) == [1, 2, 3, 4, 4, 5, 6, 7]
    assert {r["score"] for r in found} == {0.5}
    assert quality.score_quality(docs([]), labels).count() == 0


def test_statistics_do_not_depend_on_blocks():
    rng = random.Random(1)
    rows = [noise(rng, rng.randint(0, 200), "ab c\n.#|É") for _ in range(50)]
    data, offsets = texts.utf8(pa.array(rows))
    together = quality.statistics(data, offsets)
    for i, row in enumerate(rows):
        alone = quality.statistics(*texts.utf8(pa.array([row])))
        np.testing.assert_allclose(alone[0], together[i], rtol=1e-6)


def test_trees_walk_like_a_plain_loop():
    rng = np.random.default_rng(2)
    x = rng.random((300, 4))
    trees = quality.fit_trees(x, (x[:, 0] + x[:, 1] > 1).astype(float))
    for row, score in zip(x[:40], trees.score(x), strict=False):
        total = trees.base
        for node in trees.roots:
            while trees.left[node] != node:
                low = row[trees.feature[node]] <= trees.cut[node]
                node = trees.left[node] if low else trees.right[node]
            total += trees.value[node]
        assert abs(1 / (1 + np.exp(-total)) - score) < 1e-9


# --- SimHash -------------------------------------------------------------------------------


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(points, near):
    root = {p: p for p in points}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a in points:
        for b in points:
            if near(a, b):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {p: find(p) for p in points}


def test_simhash_groups_equal_brute_force(spark, docs):
    rng = random.Random(3)
    base = [" ".join(noise(rng, 4, "abcdefgh") for _ in range(150)) for _ in range(12)]
    rows = []
    for i in range(150):
        words = rng.choice(base).split()
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = noise(rng, 3)
        rows.append((1000 - i, " ".join(words)))
    rows += [(2000, None), (2001, ""), (1, "one two"), (2, "ONE  Two"), (3, "É")]
    found = {r["doc_id"]: r for r in simhash.simhash_groups(docs(rows, fp="x", rep="x")).collect()}
    prints = {i: plain_fingerprint(t) for i, t in rows}
    groups = plain_groups(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    assert len(found) == len(rows)
    for i, r in found.items():
        assert r["fingerprint"] == f"{prints[i]:016x}"
        assert r["component_id"] == groups[i]


@pytest.mark.parametrize("masks, radii", [((32, 32), (2, 1)), ((32, 32), (1, 2)), ((21, 21, 22), (1, 1, 0))])
def test_every_allocation_finds_the_same_pairs(spark, masks, radii):
    rng = random.Random(4)
    values = [rng.getrandbits(64) for _ in range(30)]
    for v in list(values):
        for _ in range(4):
            for b in rng.sample(range(64), rng.randint(1, 6)):
                v ^= 1 << b
            values.append(v)
    values = sorted({simhash.signed(v) for v in values})
    groups, at = [], 0
    for size in masks:
        groups.append(simhash._mask(range(at, at + size)))
        at += size
    frame = spark.createDataFrame([(v,) for v in values], "fp long")
    found = simhash.linked_pairs(frame, simhash.Plan(tuple(groups), radii, 0.0)).collect()
    full = (1 << 64) - 1
    near = {(a, b) for a in values for b in values if a < b and ((a ^ b) & full).bit_count() <= 4}
    assert {(r["a"], r["b"]) for r in found} == near


def test_radii_cost_least():
    costs = [[0, 5, 9, 20], [0, 1, 2, 3], [0, 4, 50, 90]]
    assert simhash.allocate(costs, 2) == (3, [-1, 2, -1 + 2]) or simhash.allocate(costs, 2)[0] == min(
        costs[0][a + 1] + costs[1][b + 1] + costs[2][c + 1]
        for a in range(-1, 3) for b in range(-1, 3) for c in range(-1, 3) if a + b + c == 2
    )


def test_simhash_of_no_rows(spark, docs):
    assert simhash.simhash_groups(docs([])).count() == 0


# --- repeated passages ---------------------------------------------------------------------


def plain_removal(rows, length=100):
    """Kept bytes by looking up every window."""
    seen, marks = set(), {}
    for doc, text in sorted(rows):
        mark = marks[doc] = np.zeros(len(text), bool)
        for p in range(len(text) - length + 1):
            window = text[p : p + length]
            if window in seen:
                mark[p : p + length] = True
            seen.add(window)
    return {doc: (bytes(np.frombuffer(t, np.uint8)[~marks[doc]]), marks[doc]) for doc, t in rows}


def repeat_rows():
    rng = random.Random(5)
    shared = [noise(rng, rng.randint(60, 400)) for _ in range(6)]
    part = lambda: rng.choice([noise(rng, rng.randint(0, 90)), rng.choice(shared), rng.choice(shared)[rng.randint(0, 50) :]])
    rows = [(900 - 3 * i, "".join(part() for _ in range(rng.randint(0, 8)))) for i in range(120)]
    rows += [(5000, "abc" * 200), (5001, "x" * 1000), (5002, "x" * 99), (5003, "x" * 100)]
    return [*rows, (5004, None), (5005, ""), (5006, rows[3][1]), (4, "abc" * 50 + "q" + "abc" * 50)]


def test_removed_bytes_equal_brute_force(spark, docs, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK_ROWS", 50)
    rows = repeat_rows()
    found = {r["doc_id"]: r for r in repeats.remove_repeats(docs(rows).repartition(5)).collect()}
    plain = plain_removal([(i, (t or "").encode()) for i, t in rows])
    assert sum(mark.sum() for _, mark in plain.values()) > 10_000
    for doc, (kept, mark) in plain.items():
        r = found[doc]
        runs = int((np.diff(np.concatenate(([0], mark.astype(int)))) == 1).sum())
        assert (bytes(r["kept"]), r["n_bytes"], r["n_removed"], r["n_spans"]) == (kept, len(mark), mark.sum(), runs)


def test_a_passage_of_many_surroundings_meets_in_bounded_arrays(spark, docs, monkeypatch, tmp_path):
    rng = random.Random(16)
    passage, line = noise(rng, 80), noise(rng, 130)
    rows = [(i, noise(rng, rng.randint(0, 90)) + passage + noise(rng, rng.randint(0, 90))) for i in range(300)]
    rows += [(1000 + i, noise(rng, 80) + line + rng.choice(["", "ab", noise(rng, 40)])) for i in range(200)]
    rows += [(2000 + i, t[: len(t) - i % 9]) for i, (_, t) in enumerate(rows[::3])]
    rows += [(3000, "x" * 700 + line[:20]), (3001, line * 3)]
    true = repeats._surrounding_batches

    def watched(batches, length):
        batches = list(batches)
        keys = [k for b in batches for k in b.column("key").to_pylist()]
        most = max(map(keys.count, set(keys)), default=0)
        with open(tmp_path / "most", "a") as out:
            out.write(f"{most}\n")
        yield from true(iter(batches), length)

    monkeypatch.setattr(repeats, "CHUNK_ROWS", 50)
    monkeypatch.setattr(repeats, "_surrounding_batches", watched)
    found = {r["doc_id"]: r for r in repeats.remove_repeats(docs(rows).repartition(5)).collect()}
    for doc, (kept, mark) in plain_removal([(i, t.encode()) for i, t in rows]).items():
        assert (bytes(found[doc]["kept"]), found[doc]["n_removed"]) == (kept, mark.sum())
    assert 1 < max(map(int, (tmp_path / "most").read_text().split())) <= 50


def test_surroundings_hold_only_strings_with_the_bytes_of_their_key(spark, docs, monkeypatch, tmp_path):
    rng = random.Random(17)
    shared = [noise(rng, rng.randint(110, 170)) for _ in range(5)]
    rows = [(i, noise(rng, rng.randint(0, 120)) + rng.choice(shared)[i % 8 :] + noise(rng, 120)) for i in range(60)]
    true = repeats._surrounding_batches

    def watched(batches, length):
        batches = list(batches)
        with open(tmp_path / "most", "a") as out:
            out.writelines(f"{len(c)}\n" for b in batches for c in b.column("content").to_pylist())
        yield from true(iter(batches), length)

    monkeypatch.setattr(repeats, "_surrounding_batches", watched)
    found = {r["doc_id"]: r for r in repeats.remove_repeats(docs(rows).repartition(5)).collect()}
    for doc, (kept, mark) in plain_removal([(i, t.encode()) for i, t in rows]).items():
        assert (bytes(found[doc]["kept"]), found[doc]["n_removed"]) == (kept, mark.sum())
    sizes = list(map(int, (tmp_path / "most").read_text().split()))
    assert len(sizes) > 20 and 100 <= min(sizes) and max(sizes) <= 130


@pytest.mark.parametrize("letters", ["ab", "a\0", "é\0x"])
@pytest.mark.parametrize("one_hash", [False, True])
def test_suffix_array_has_all_repeats_and_nothing_else(monkeypatch, letters, one_hash):
    if one_hash:
        monkeypatch.setattr(repeats, "prefix_hashes", lambda data, n: np.zeros(len(data) - n + 1, np.uint64))
    rng, length = random.Random(18), 11
    texts_ = [noise(rng, rng.randint(0, 60), letters).encode() for _ in range(14)]
    cuts = [(d, p, t[p : p + 40]) for d, t in enumerate(texts_) for p in (0, 7, 19) if p < max(1, len(t))]
    rng.shuffle(cuts)
    given, starts = np.array([7 * d for d, _, _ in cuts]), np.array([p for _, p, _ in cuts])
    (d, s, e), _, (doc, at) = repeats.compare_surroundings(given, given, starts, [c for *_, c in cuts], length)
    places = {(7 * d, p + i, c[i : i + length]) for d, p, c in cuts for i in range(len(c) - length + 1)}
    first, held = {}, {}
    for place in sorted(places):
        first.setdefault(place[2], place)
        held[place[2]] = held.get(place[2], 0) + 1
    again = {p[:2] for p in places if first[p[2]] != p}
    got = {(int(a), q) for a, b, c in zip(d, s, e, strict=True) for q in range(b, c - length + 1)}
    assert again and got == again
    if not one_hash:
        counted = {p[:2] for p in places if held[p[2]] > 1}
        assert counted <= set(zip(doc.tolist(), at.tolist(), strict=True))
        assert len(doc) < sum(max(0, len(c) - length + 1) for *_, c in cuts)


def test_removal_of_odd_rows(spark, docs):
    found = repeats.remove_repeats(docs(ODD, spans="clash", row="clash")).collect()
    plain = plain_removal([(i, (t or "").encode()) for i, t in ODD if i and (i, t) != (4, "a")] + [(4, b"a")])
    assert {r["doc_id"]: bytes(r["kept"]) for r in found} == {d: k for d, (k, _) in plain.items()}
    assert repeats.remove_repeats(docs([])).count() == 0


def test_stage_keeps_columns_and_clean_texts(spark, docs):
    rng = random.Random(6)
    rows = [(i, noise(rng, 300)) for i in range(20)]
    given = docs(rows + [(99, rows[0][1] + " tail")], row="extra")
    found = repeats.drop_repeats(spark, given, "").collect()
    by_id = {r["doc_id"]: r for r in found}
    assert list(found[0].asDict()) == given.columns
    assert all(by_id[i]["text"] == t and by_id[i]["row"] == "extra" for i, t in rows)
    assert (by_id[99]["text"], by_id[99]["n_chars"]) == (" tail", 5)


def test_maximal_repeats_list_all_occurrences():
    rng = random.Random(7)
    contents = [noise(rng, rng.randint(20, 60), "ab").encode() for _ in range(12)]
    docs_, starts = np.arange(12), np.zeros(12, np.int64)
    _, found, (doc, at) = repeats.compare_surroundings(docs_, docs_, starts, contents, 8)
    got = {}
    for length, low, high in found:
        places = {(int(doc[i]), int(at[i])) for i in range(low, high + 1)}
        d, p = min(places)
        got[contents[d][p : p + length]] = places
    every = {}
    for d, c in enumerate(contents):
        for n in range(8, len(c) + 1):
            for p in range(len(c) - n + 1):
                every.setdefault(c[p : p + n], set()).add((d, p))
    differ = lambda values: len(set(values)) > 1 or None in values
    maximal = {
        s: places
        for s, places in every.items()
        if len(places) > 1
        and differ([contents[d][p - 1] if p else None for d, p in places])
        and differ([contents[d][p + len(s)] if p + len(s) < len(contents[d]) else None for d, p in places])
    }
    assert got == maximal


# --- mixing --------------------------------------------------------------------------------


def test_mixing_reaches_target_shares(spark, docs):
    frame = docs([(i, "word " * 20) for i in range(6000)], copy="clash", _rate="clash")
    found = mixing.mix_sources(frame, {"s0": 3.0, "s1": 1.0}).groupBy("source").count().collect()
    share = {r["source"]: r["count"] / 6000 for r in found}
    assert set(share) == {"s0", "s1"}
    assert abs(share["s0"] - 0.75) < 0.04 and abs(share["s1"] - 0.25) < 0.03


def test_poisson_counts_follow_the_distribution(spark):
    from pyspark.sql import functions as F

    rows = spark.range(20000).select(
        mixing.poisson_inverse(F.lit(2.5), mixing.uniform(F.lit("1"), F.col("id").cast("string"))).alias("k")
    )
    k = np.array([r["k"] for r in rows.collect()])
    assert abs(k.mean() - 2.5) < 0.05 and abs(k.var() - 2.5) < 0.12
    assert abs((k == 0).mean() - np.exp(-2.5)) < 0.01


def test_mixing_of_odd_rows(spark, docs):
    odd = docs(ODD).selectExpr("doc_id", "text", "lang", "CASE WHEN doc_id > 2 THEN source END AS source", "n_chars")
    once, again = (sorted(map(repr, mixing.mix_sources(odd).collect())) for _ in range(2))
    assert once == again
    assert mixing.mix_sources(docs([])).count() == 0


# --- SentencePiece -------------------------------------------------------------------------


def test_ids_and_texts_are_those_of_the_library():
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    vocab = pieces.load_vocabulary(pieces.MODEL)
    rng = random.Random(8)
    rows = ["Hello  world", "  a", "a\nb", "", "▁x", "a  ", "é ﬁ", "\0a\0", "日本語 😀😀", "x" * 500, "the" * 99 + " " * 70]
    rows += [noise(rng, rng.randint(0, 200), "abct he in\n▁é日😀 .,$#") for _ in range(300)]
    ids, bounds = pieces.encode_batch(rows, vocab)
    decoded = pieces.decode_batch(ids, bounds, vocab)
    for i, row in enumerate(rows):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == model.encode(row)
        assert decoded[i].decode() == row.replace("▁", " ")


def test_encoding_of_odd_rows(spark, docs):
    found = pieces.encode_texts(docs(ODD, ids="clash", exact="clash")).collect()
    assert sorted(r["doc_id"] for r in found) == [1, 2, 3, 4, 4, 5, 6, 7]
    for r in found:
        text = dict(ODD)[r["doc_id"]] or ""
        assert r["exact"] and r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert r["n_tokens"] == len(r["ids"])
    assert pieces.encode_texts(docs([])).count() == 0


# --- language ------------------------------------------------------------------------------


def test_forward_backward_equals_a_plain_loop():
    rng = np.random.default_rng(9)
    lengths = np.array([1, 5, 200, 64, 65, 3])
    scores, transfer = rng.random((lengths.sum(), 3)) + 0.01, rng.random((3, 3)) + 0.1
    found, _, _ = language.forward_backward(scores, lengths, transfer)
    begin = 0
    for n in lengths:
        e = scores[begin : begin + n]
        forward, state = np.zeros((n, 3)), np.ones(3) / 3
        for t in range(n):
            state = (state @ transfer) * e[t]
            state = forward[t] = state / state.sum()
        back = np.ones((n, 3))
        for t in range(n - 2, -1, -1):
            back[t] = transfer @ (e[t + 1] * back[t + 1])
            back[t] /= back[t].sum()
        both = forward * back
        np.testing.assert_allclose(found[begin : begin + n], both / both.sum(axis=1, keepdims=True))
        begin += n


def switched(rng):
    words = {"aa": ["kalo", "meka", "tolka"], "bb": ["shrim", "shull", "shrant"]}
    first = [rng.choice(words["aa"]) for _ in range(30)]
    second = [rng.choice(words["bb"]) for _ in range(10)]
    return first, second


def test_words_of_mixed_texts_are_labelled_one_by_one(spark):
    rng = random.Random(10)
    rows = []
    for i in range(120):
        a, b = switched(rng)
        rows.append((i, " ".join(a if i % 2 else b), "aa" if i % 2 else "bb"))
    field = language.fit_field([t for _, t, _ in rows], [lang for *_, lang in rows])
    a, b = switched(rng)
    frame = spark.createDataFrame([(1, " ".join(a + b)), (2, None), (3, "12 …"), (4, "")], "doc_id long, text string")
    found = {r["doc_id"]: r for r in language.label_languages(frame, field).collect()}
    assert found[1]["word_langs"] == {"aa": 30, "bb": 10}
    assert (found[1]["lang_pred"], found[1]["n_switches"]) == ("aa", 1)
    assert all((found[i]["lang_pred"], found[i]["score"]) == ("und", 0.0) for i in (2, 3, 4))


def test_language_of_held_out_documents(spark):
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = language.identify_languages(given).join(given.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r["held_out"]]
    assert len(found) == given.count() and len(held) > 20
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.95 * len(held)


def test_a_rare_language_is_learnt(spark):
    rng = random.Random(17)
    text = lambda words: " ".join(rng.choice(words) for _ in range(30))
    rows = [(i, text(["the", "house", "with", "many"]), "en") for i in range(2000)]
    rows += [(5000 + i, text(["żółw", "jest", "mały", "więc"]), "pl") for i in range(8)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language.identify_languages(frame, train_rows=20).collect()
    assert {(r["doc_id"] >= 5000, r["lang_pred"]) for r in found} == {(False, "en"), (True, "pl")}


def test_language_of_odd_rows(spark, docs):
    found = language.identify_languages(docs(ODD, score="clash")).collect()
    assert sorted(r["doc_id"] for r in found) == [1, 2, 3, 4, 4, 5, 6, 7]
    assert {r["doc_id"] for r in found if r["lang_pred"] == "und"} == {1, 2, 3, 5}
    assert language.identify_languages(docs([])).count() == 0


# --- toxicity ------------------------------------------------------------------------------


def test_gradients_of_the_network():
    rng = np.random.default_rng(11)
    w = {k: v.astype(float) for k, v in toxicity.new_weights(5, 1).items()}
    table = rng.normal(size=(6, toxicity.WORD_SIZE + toxicity.LETTER_SIZE))
    windows = np.array([[0, 1, 2, 3, -1, -1], [5, 4, 3, 2, 1, 0], [2, 2, -1, -1, -1, -1]])
    y, counts = np.array([1.0, 0, 1]), np.array([1.0, 2, 1])

    def loss():
        p = toxicity.score_windows(table, windows, w)
        return -(counts * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / counts.sum()

    _, grads, d_table = toxicity.score_windows(table, windows, w, y, counts)
    for array, slope in [*((w[k], grads[k]) for k in grads), (table, d_table)]:
        place = tuple(rng.integers(0, n) for n in array.shape)
        kept = array[place]
        ends = []
        for step in (0.01, -0.01):
            array[place] = kept + step
            ends.append(loss())
        array[place] = kept
        assert abs((ends[0] - ends[1]) / 0.02 - slope[place]) < 1e-3


def test_windows_cover_every_word():
    counts = np.array([0, 1, 16, 17, 28, 29, 100])
    codes = np.arange(counts.sum())
    windows, rows = toxicity.cut_windows(codes, counts)
    assert set(windows[windows >= 0]) == set(codes)
    number = np.bincount(rows, minlength=len(counts))
    assert number.tolist() == [0, 1, 1, 2, 3, 3, 12]
    phrases = {tuple(range(at, at + 9)) for at in range(counts.sum() - 100, counts.sum() - 8)}
    assert phrases <= {tuple(w[i : i + 9]) for w in windows for i in range(len(w) - 8)}


def test_toxicity_learns_words(spark, docs):
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(300):
        words = [noise(rng, 5, "abcdefgh") for _ in range(40)]
        if i % 3 == 0:
            words[rng.randrange(40)] = "zounds"
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(i % 3 == 0)))
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = toxicity.score_toxicity(docs(rows), labels).collect()
    held = [r for r in found if r["held_out"]]
    assert sum(r["predicted"] == (r["doc_id"] % 3 == 0) for r in held) >= 0.9 * len(held)
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)


def test_toxicity_of_odd_rows(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = toxicity.score_toxicity(docs(ODD, score="clash"), labels).collect()
    assert sorted(r["doc_id"] for r in found) == [1, 2, 3, 4, 4, 5, 6, 7]
    assert all(0 <= r["score"] <= 1 for r in found)
    assert toxicity.score_toxicity(docs([]), labels).count() == 0
