"""Vector codes, scaled sketches and the fill-in-middle transformation against plain versions."""

import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from weekloom.llm import codes, infill, sketches
from weekloom.llm.texts import RADIX, utf8

WORDS = "the of sea ship wind under pale green light went home again never old".split()
M64 = (1 << 64) - 1


# -- vector codes -------------------------------------------------------------------------


@pytest.mark.parametrize("bits", [8, 20, 28, 30])
def test_products_are_exact_for_any_limb_width(bits):
    draw = np.random.default_rng(bits)
    a = draw.integers(-(1 << bits), 1 << bits, (50, 4))
    b = draw.integers(-(1 << bits), 1 << bits, (7, 4))
    plain = [[sum(int(x) * int(y) for x, y in zip(p, q, strict=True)) for q in b] for p in a]
    for width in (3, 9, 25, None):
        assert codes.products(a, b, width).tolist() == plain


def test_limbs_of_the_greatest_numbers():
    values = np.array([[2**62, -(2**62), 2**63 - 1, -(2**63), 0, -1]])
    parts = codes.limbs(values, 25)
    assert all(np.abs(p).max() <= 2**25 for p in parts)
    back = [sum(int(p[0, i]) << (25 * k) for k, p in enumerate(parts)) for i in range(6)]
    assert back == values[0].tolist()
    assert all(terms * 2 ** (2 * codes.limb_width(terms)) <= 2**53 for terms in (1, 3, 4, 5, 4096))


def plain_codes(rows, parts=codes.PARTS, entries=codes.ENTRIES, rounds=codes.ROUNDS):
    """(id, label, vector) rows to (id, code, error, label_error, digest), with Python integers."""
    fine = [
        (i, label, v) for i, label, v in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    fine.sort(key=lambda row: (row[0] is None, row[0], row[2]))
    size = max((len(v) for *_, v in fine), default=0)
    width = max(1, -(-size // parts))
    whole = [
        [math.floor(Fraction(x) * 256) for x in v] + [0] * (parts * width - len(v)) for *_, v in fine
    ]
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for v in whole]
    books = [[v[p] for v in cut[:entries]] for p in range(parts)]

    def assign(part, point):
        gaps = [sum((x - y) ** 2 for x, y in zip(point, entry, strict=True)) for entry in books[part]]
        return gaps.index(min(gaps)), min(gaps)

    for _ in range(rounds):
        owners = [[assign(p, v[p])[0] for v in cut] for p in range(parts)]
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [v[p] for v, owner in zip(cut, owners[p], strict=True) if owner == e]
                if mine:
                    books[p][e] = [sum(column) // len(mine) for column in zip(*mine, strict=True)]
    numbers = ",".join(str(x) for part in books for entry in part for x in entry)
    digest = hashlib.sha256(numbers.encode()).hexdigest()
    found = [[assign(p, v[p]) for p in range(parts)] for v in cut]
    errors = [sum(gap for _, gap in one) for one in found]
    out = []
    for (i, label, _), one, error in zip(fine, found, errors, strict=True):
        same = sum(e for (_, other, _), e in zip(fine, errors, strict=True) if other == label)
        fits = lambda n: n if n < 2**63 else None
        out.append((i, "".join(f"{e:02x}" for e, _ in one), fits(error), fits(same), digest))
    return out


def vectors_frame(spark, rows):
    frame = spark.createDataFrame(
        [(i, v, label) for i, label, v in rows], "vec_id long, embedding array<double>, label int"
    )
    return frame.selectExpr("*", "'x' AS code", "'y' AS error", "0 AS _label")


def coded(spark, tmp_path, rows):
    vectors_frame(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    return sorted(map(tuple, codes.op11_codes(spark, str(tmp_path)).collect()), key=str)


def test_codes_equal_plain_ones(spark, tmp_path):
    draw = random.Random(5)
    rows = [
        (i, draw.choice([None, 1, 2, 3]), [draw.gauss(0, 1) for _ in range(32)]) for i in range(150)
    ]
    rows += [(7, 1, rows[9][2]), (None, None, rows[3][2]), (None, 2, [0.0] * 32), rows[20], rows[20]]
    rows += [(200, 1, None), (201, 1, [None] * 32), (202, 2, [math.nan] * 32), (203, 2, [math.inf] * 32)]
    assert coded(spark, tmp_path, rows) == sorted(plain_codes(rows), key=str)


def test_codes_of_huge_and_short_vectors(spark, tmp_path):
    draw = random.Random(6)
    rows = [(i, i % 2, [draw.gauss(0, 10.0 ** (i % 14)) for _ in range(16)]) for i in range(90)]
    rows += [(90, 1, [1e200] * 16), (91, 0, [-1e308, 1e-300] + [0.0] * 14), (92, 0, []), (93, 1, [0.5] * 5)]
    found = coded(spark, tmp_path, rows)
    assert found == sorted(plain_codes(rows), key=str)
    assert any(row[2] is None for row in found)


def test_codes_of_no_vectors(spark, tmp_path):
    assert coded(spark, tmp_path, []) == []


def test_a_few_vectors_code_themselves(spark, tmp_path):
    rows = [(i, None, [float(i)] * 16) for i in range(3)]
    found = coded(spark, tmp_path, rows)
    assert [row[1:4] for row in found] == [(f"{i:02x}" * 16, 0, 0) for i in range(3)]


def test_rare_labels_meet_their_sums_in_a_shuffle(spark):
    rows = [(i, i % 40 if i % 3 else 0, i) for i in range(400)] + [(400, None, 1), (401, None, 2)]
    frame = spark.createDataFrame(rows, "vec_id long, label int, error long")
    expected = {i: sum(e for _, other, e in rows if other == label) for i, label, _ in rows}
    found = codes.with_label_error(frame, share=5).collect()
    assert {row["vec_id"]: row["label_error"] for row in found} == expected
    assert len(found) == len(rows)


# -- scaled sketches ----------------------------------------------------------------------


def plain_mix(x):
    x = (x ^ (x >> 31)) * 0xBF58476D1CE4E5B9 & M64
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & M64
    return x ^ (x >> 31)


def plain_sketch(text, words=5, bits=3):
    found = (text or "").encode(errors="surrogateescape").lower().split()
    radix = int(RADIX)

    def word(w):
        return plain_mix((sum((b + 1) * pow(radix, i, 1 << 64) for i, b in enumerate(w)) + len(w)) & M64)

    hashes = [word(w) for w in found]
    shingles = [hashes[i : i + words] for i in range(len(hashes) - words + 1)] or [hashes] * bool(hashes)
    every = {
        plain_mix(sum(h * pow(radix, i + 1, 1 << 64) for i, h in enumerate(s)) & M64) for s in shingles
    }
    return sorted(h for h in every if h < 1 << (64 - bits)) or sorted(every)[:1]


def share(a, b):
    return len(set(a) & set(b)) / len(a) if a and b else float(a == b)


def prose(draw, n):
    return " ".join(draw.choice(WORDS) + draw.choice(["", "", "s", "!"]) for _ in range(n))


def test_sketches_equal_plain_ones():
    draw = random.Random(1)
    texts = ["", None, " \t", "One", "one TWO three", "é ü " * 9, *(prose(draw, n) for n in (4, 5, 6, 80, 3000))]
    found = sketches.sketch_texts(*utf8(pa.array(texts, pa.string())))
    assert [s.tolist() for s in found] == [plain_sketch(t) for t in texts]
    assert [sketches.parsed(sketches.written(s)).tolist() for s in found] == [plain_sketch(t) for t in texts]


def test_words_are_hashed_alike_in_runs_of_any_size(monkeypatch):
    draw = random.Random(2)
    texts = pa.array([prose(draw, n) for n in (3, 900, 0, 50)])
    whole = sketches.sketch_texts(*utf8(texts))
    monkeypatch.setattr(sketches, "BLOCK_BYTES", 40)
    assert [s.tolist() for s in sketches.sketch_texts(*utf8(texts))] == [s.tolist() for s in whole]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.sampled_from(WORDS), max_size=40).map(" ".join), max_size=5))
def test_merging_sketches_is_sketching_the_union(texts):
    found = sketches.sketch_texts(*utf8(pa.array(texts, pa.string())))
    every = set()
    for text in texts:
        every |= set(plain_sketch(text, bits=0))
    expected = sorted(h for h in every if h < 1 << 61) or sorted(every)[:1]
    assert sketches.merge(found).tolist() == expected


def test_containment_does_not_depend_on_sizes():
    draw = random.Random(3)
    vocabulary = [f"w{i}" for i in range(5000)]
    big = [draw.choice(vocabulary) for _ in range(20000)]
    part = big[4000:5000]
    mixed = part[:500] + [draw.choice(vocabulary) for _ in range(500)]
    texts = pa.array([" ".join(words) for words in (big, part, mixed)])
    whole, inner, half = sketches.sketch_texts(*utf8(texts))
    assert sketches.containment(inner, whole) == 1
    assert abs(sketches.containment(half, whole) - 0.5) < 0.15
    assert sketches.containment(whole, inner) < 0.1


def plain_likeness(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for i, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        own, changed, following = map(plain_sketch, (text, edited, after))
        hexed = lambda s: "".join(f"{h:016x}" for h in s)
        out.append(
            (doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), hexed(own), hexed(changed),
             share(own, changed), share(own, following))
        )
    return sorted(out, key=str)


def test_likeness_equals_a_plain_version(spark, docs):
    draw = random.Random(4)
    rows = [(3 * i, prose(draw, draw.choice([0, 1, 4, 30, 200]))) for i in range(300)]
    rows += [(901, None), (-5, "ünï 😀 çödé " * 30), (2**63 - 1, "last"), (-(2**63), "first " * 50)]
    rows += [(904, prose(draw, 20000))]
    frame = docs(rows, guest="x", range="y", place="z")
    found = sorted(map(tuple, sketches.edited_likeness(frame).collect()), key=str)
    assert found == plain_likeness(rows)


def test_likeness_of_repeated_and_missing_ids(spark, docs):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "x y"), (None, "p q r s t"), (None, None)]
    found = sketches.edited_likeness(docs(rows)).collect()
    assert sorted(str(r["doc_id"]) for r in found) == ["1", "1", "2", "None", "None"]
    assert [r["near_next"] for r in found if r["doc_id"] == 1].count(1.0) == 1


def test_likeness_of_one_document_and_of_none(spark, docs):
    (only,) = sketches.edited_likeness(docs([(4, "abcdef")])).collect()
    assert only["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest()
    assert only["near_next"] == 1
    assert sketches.edited_likeness(docs([])).collect() == []


def test_fingerprints_merge_by_key(spark, docs):
    draw = random.Random(8)
    rows = [(i, prose(draw, 60)) for i in range(9)] + [(9, ""), (10, "one two")]
    found = sketches.fingerprints(docs(rows)).selectExpr("doc_id", "fingerprint", "doc_id % 2 AS side")
    assert {r["doc_id"]: sketches.parsed(r["fingerprint"]).tolist() for r in found.collect()} == {
        i: plain_sketch(t) for i, t in rows
    }
    hashes = {}
    for row in sketches.merged(found, "side").collect():
        hashes.setdefault(row["side"], set()).add(int(row["hash"], 16))
    for side in (0, 1):
        union = {h for i, t in rows if i % 2 == side for h in plain_sketch(t, bits=0)}
        assert hashes[side] == {h for h in union if h < 1 << 61}


# -- fill in the middle -------------------------------------------------------------------

PIECES = st.sampled_from(["<", ">", "P", "S", "M", "<P", "S>", "<P>", "ab", "é", "😀", "\n", ""])


@settings(max_examples=200, deadline=None)
@given(st.lists(PIECES, max_size=12).map("".join), st.integers(0, 40), st.integers(0, 40))
def test_rotations_give_the_segments_and_go_back(text, one, two):
    n = len(text)
    first, second = sorted((one % (n + 1), two % (n + 1)))
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    raw = text.encode()
    places = infill.code_points(np.frombuffer(raw, np.uint8))
    expected = {
        "psm": f"<P>{prefix}<S>{suffix}<M>{middle}",
        "spm": f"<S>{suffix}<P>{prefix}<M>{middle}",
        "plain": text,
    }
    for form, output in expected.items():
        made = infill.transform(raw, form, int(places[first]), int(places[second]))
        assert made.decode() == output
        if form == "plain" or not any(s in text for s in ("<P>", "<S>", "<M>")):
            assert infill.inverse(made, form) == raw


def test_all_forms_come_back_through_spark(spark, docs):
    draw = random.Random(9)
    rows = [(i, prose(draw, draw.choice([0, 1, 9, 90])) + draw.choice(["", "é", "<S", "<M>"])) for i in range(300)]
    rows += [(None, "no id " * 9), (5, None), (6, ""), (7, rows[1][1]), (7, rows[1][1]), (301, "x" * 300_000)]
    frame = docs(rows, output="o", form="f", restored="r")
    made = infill.restore(infill.fill_in_middle(frame)).collect()
    key = lambda pair: (pair[0] is None, pair[0] or 0, pair[1])
    assert sorted(((r["doc_id"], r["restored"]) for r in made), key=key) == sorted(
        ((i, t or "") for i, t in rows), key=key
    )
    forms = [r["form"] for r in made]
    assert 0 < forms.count("spm") < forms.count("psm")
    for row in made:
        plain = row["restored"] == "" or "<M>" in row["restored"]
        assert not plain or row["form"] == "plain"
        assert (row["prefix_chars"] is None) == (row["form"] == "plain")
        if row["form"] == "psm":
            start = row["output"][3 : 3 + row["prefix_chars"]]
            assert row["restored"].startswith(start)
            assert row["output"].startswith(f"<P>{start}<S>")


def test_share_of_forms_is_a_parameter(spark, docs):
    frame = docs([(i, "some text here") for i in range(200)])
    assert {r["form"] for r in infill.fill_in_middle(frame, transformed=0).collect()} == {"plain"}
    assert {r["form"] for r in infill.fill_in_middle(frame, 100, 100).collect()} == {"spm"}
    assert infill.fill_in_middle(docs([])).collect() == []
