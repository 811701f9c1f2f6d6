"""Removal of repeated passages by maximal repeats of an enhanced suffix array.

Every string of ``length`` bytes picks an anchor, the gram of GRAM bytes in it with the smallest
hash, so equal strings pick equal anchors at equal places.  Anchors with equal grams are brought
together by a shuffle.  Where the surroundings of two anchors are equal as far as any string
around them reaches, the later is repeated as a whole.  The different surroundings of one gram
are compared by a suffix array and its common-prefix intervals.  Where they are too many for one
array, their strings of ``length`` bytes are grouped instead.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from weekloom.llm.storage import stored
from weekloom.llm.texts import blocks, mix, ragged, span_hashes

#: Bytes of a string that counts as repeated, and of the grams that anchor it.
LENGTH, GRAM = 100, 40
#: Surroundings handled in one suffix array; those of one key stay together.  A key of more has its
#: strings grouped.
CHUNK_ROWS = 8_000
BLOCK_BYTES = 1 << 20
#: A place is packed in a long: first byte, bytes before the gram (8 bits), bytes in all (24).
SIZE_BITS, LEFT_BITS = 24, 8

_STEPS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB],
    np.uint64,
)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """The hash of the GRAM bytes from each place on, by doubling; GRAM is 32 + 8."""
    h = data.astype(np.uint64) + np.uint64(1)
    eight = None
    for k, width in enumerate((1, 2, 4, 8, 16)):
        h = h[:-width] * _STEPS[k] + h[width:]
        h ^= h >> np.uint64(29)
        if width == 4:
            eight = h
    n = len(data) - GRAM + 1
    return mix(h[:n] * _STEPS[5] + eight[32 : 32 + n])


def find_anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH):
    """Anchors of all strings of ``length`` bytes: place, gram hash, hash of surroundings, row,
    bytes to the left and to the right that belong to some string around the anchor."""
    empty = np.zeros(0, np.int64)
    if len(data) < length:
        return empty, empty.astype(np.uint64), empty.astype(np.uint64), empty, empty, empty
    grams = gram_hashes(data)
    spare = length - GRAM
    keys = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    width, least = 1, keys
    while 2 * width <= spare + 1:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    n = len(data) - length + 1
    rest = spare + 1 - width
    least = np.minimum(least[:n], least[rest : rest + n])
    ends = np.repeat(offsets[1:], np.diff(offsets))[:n]
    least = least[np.arange(length, length + n) <= ends]
    place = np.unique(least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    row = np.searchsorted(offsets, place, "right") - 1
    left = np.minimum(spare, place - offsets[row])
    right = np.minimum(spare, offsets[row + 1] - place - GRAM)
    around = np.empty(len(place), np.uint64)
    full = (left == spare) & (right == spare)
    total = np.zeros(int(full.sum()), np.uint64)
    for k, shift in enumerate(range(-spare, spare + 1, GRAM)):
        total = mix(total * _STEPS[k] + grams[place[full] + shift])
    around[full] = mix(total * _STEPS[4] + grams[place[full] + spare])  # up to the end
    part = ~full
    around[part] = mix(span_hashes(data, (place - left)[part], (left + GRAM + right)[part]) + left[part].astype(np.uint64))
    return place, grams[place], around, row, left, right


def packed_place(start, left, size):
    return (start << (SIZE_BITS + LEFT_BITS)) | (left << SIZE_BITS) | size


def _merge(row: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Unite overlapping or touching intervals of equal rows."""
    order = np.lexsort((start, row))
    row, start, end = row[order], start[order], end[order]
    if not len(row):
        return row, start, end
    wide = np.int64(max(int(end.max()) + 1, 1))
    reach = np.maximum.accumulate(row * wide + end)
    fresh = np.concatenate(([True], row[1:] * wide + start[1:] > reach[:-1]))
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(row)) - 1
    return row[first], start[first], reach[last] - row[first] * wide


def _anchor_batches(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Anchors to compare with those of other tasks, and runs repeated within a block.

    Of anchors with equal grams and surroundings only the earliest in the block goes on; the
    others are repeated, whatever lies elsewhere.  A run has a negative place, and as its gram
    a hash that deals runs out evenly.
    """
    for batch, data, offsets in blocks(batches, BLOCK_BYTES):
        place, gram, around, row, left, right = find_anchors(data, offsets, length)
        doc = batch.column("doc_id").to_numpy(zero_copy_only=False)
        start = place - left - offsets[row]
        size = left + GRAM + right
        order = np.lexsort((start, doc[row], around, gram))
        same = np.zeros(len(order), bool)
        g, a = gram[order], around[order]
        same[1:] = (g[1:] == g[:-1]) & (a[1:] == a[:-1])
        again, keep = order[same], order[~same]
        r, s, e = _merge(row[again], start[again], (start + size)[again])
        most = (1 << SIZE_BITS) - 1
        pieces = -(-(e - s) // most)
        at = np.repeat(np.arange(len(r)), pieces)
        inner = np.arange(len(at)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        s_cut = s[at] + inner * most
        run = packed_place(s_cut, 0, np.minimum(most, e[at] - s_cut))
        spread = mix(doc[r[at]].astype(np.uint64) * _STEPS[0] + run.astype(np.uint64))
        yield pa.record_batch(
            {
                "gram": pa.array(np.concatenate([gram[keep], spread]).view(np.int64)),
                "around": pa.array(np.concatenate([around[keep], spread]).view(np.int64)),
                "doc": pa.array(np.concatenate([doc[row[keep]], doc[r[at]]])),
                "place": pa.array(
                    np.concatenate([packed_place(start[keep], left[keep], size[keep]), -run])
                ),
            }
        )


def prefix_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """A hash of the ``length`` bytes from each place on, by doubling; the last two widths overlap."""
    h, width, k = data.astype(np.uint64) + np.uint64(1), 1, 0
    while 2 * width <= length:
        h = h[:-width] * _STEPS[k % 5] + h[width:]
        h ^= h >> np.uint64(29)
        k, width = k + 1, 2 * width
    n, rest = len(data) - length + 1, length - width
    return mix(h[:n] * _STEPS[5] + h[rest : rest + n])


def sorted_suffixes(data: np.ndarray, starts: np.ndarray, rest: np.ndarray, length: int):
    """The suffix array of those ``starts`` whose first ``length`` bytes occur more than once: their
    indexes, in the order of the text there, and the length of the prefix each shares with the one
    before; ``rest`` bytes of each count, ``length`` or more.

    Hashes find suffixes with equal beginnings; the bytes are compared all the same.
    """
    depth = int(rest.max(initial=length))
    padded = np.concatenate([data, np.zeros(depth + 16, np.uint8)])
    eights = np.ndarray(len(padded) - 7, ">u8", padded, strides=(1,))

    def words(at, count):
        drop = np.uint64(8) * (8 - np.clip(count, 0, 8)).astype(np.uint64)
        return (eights[at].astype(np.uint64) >> drop) << drop

    hashes = prefix_hashes(padded, length)[starts]
    by = np.argsort(hashes)
    twin = hashes[by][1:] == hashes[by][:-1]
    by = by[np.concatenate(([False], twin)) | np.concatenate((twin, [False]))] if len(twin) else by[:0]
    at, rest = starts[by], rest[by]
    fresh = np.concatenate(([True], hashes[by][1:] != hashes[by][:-1]))[: len(by)]
    first, kind = np.flatnonzero(fresh), np.cumsum(fresh) - 1
    heads = [words(at + k, np.int64(length - k)) for k in range(0, length, 8)]
    if all((h == h[first][kind]).all() for h in heads):
        rank = np.argsort(np.lexsort([h[first] for h in reversed(heads)]))[kind]
    else:  # different beginnings with one hash
        rank = np.unique(np.stack(heads, 1), axis=0, return_inverse=True)[1].reshape(-1)
    tails = [words(at + k, rest - k) for k in range(length, depth, 8)]
    order = np.lexsort([*reversed(tails), rank])
    by, rest, rank = by[order], rest[order], rank[order]
    equal = rank[1:] == rank[:-1]
    shared = np.where(equal, length, 0)
    bounds = np.uint64(1) << np.arange(0, 64, 8, dtype=np.uint64)
    for tail in tails:
        tail = tail[order]
        differ = tail[1:] ^ tail[:-1]
        shared += np.where(equal, 8 - np.searchsorted(bounds, differ, "right"), 0)
        equal &= differ == 0
    common = np.zeros(len(by), np.int64)
    common[1:] = np.minimum(shared, np.minimum(rest[:-1], rest[1:]))
    return by, common


def common_intervals(common: np.ndarray, before: np.ndarray, age: np.ndarray, length: int):
    """The common-prefix intervals of ``length`` or more, those of the longest prefix first; each takes in
    the intervals next to each other that share its prefix, and counts as one from then on.

    ``before`` is the byte in front of each suffix (-1: unknown), ``age`` its order of origin.
    Returns the maximal repeats as rows of (length, first, last) in suffix order, those whose occurrences
    differ in the byte before (an unknown byte differs from all), and for each suffix the length over which it is
    also found earlier.
    """
    repeats, again = [np.zeros((0, 3), np.int64)], np.zeros(len(common), np.int64)
    places = np.arange(len(common))
    # An interval's first suffix has its last, its oldest (age and place) and its byte; its last has its first.
    first, last, byte, oldest = places.copy(), places.copy(), before.copy(), (age << 32) | places
    edges = np.flatnonzero(common >= length)
    edges = edges[np.argsort(-common[edges], kind="stable")]
    cuts = np.flatnonzero(np.diff(common[edges])) + 1
    for joins in np.split(edges, cuts) if len(edges) else []:
        prefix, left = common[joins[0]], first[joins - 1]
        runs = np.flatnonzero(np.concatenate(([True], left[1:] != joins[:-1])))
        members = np.insert(joins, runs, left[runs])
        begin = runs + np.arange(len(runs))
        head, end = members[begin], last[joins[np.append(runs[1:], len(joins)) - 1]]
        eldest = np.minimum.reduceat(oldest[members], begin)
        same = np.repeat(eldest >> 32, np.diff(np.append(begin, len(members))))
        later = oldest[members][(oldest[members] >> 32) > same]
        again[later & 0xFFFFFFFF] = prefix
        least, most = (f.reduceat(byte[members], begin) for f in (np.minimum, np.maximum))
        oldest[head], last[head], first[end] = eldest, end, head
        byte[head] = np.where(least == most, least, -1)
        differ = byte[head] == -1
        repeats.append(np.stack([np.full(int(differ.sum()), prefix), head[differ], end[differ]], 1))
    return np.concatenate(repeats), again


def compare_surroundings(keys, docs, starts, contents: list[bytes], length: int):
    """Repeats among strings cut from documents: (doc, start, end) of what is found earlier, and
    the maximal repeat groups as (length, [(doc, start), ...]).

    Strings are given by document and first byte; equal origins in overlapping strings are one.
    """
    data = np.frombuffer(b"\0".join(contents) + b"\0", np.uint8)
    sizes = np.array([len(c) for c in contents], np.int64)
    begin = np.cumsum(sizes + 1) - sizes - 1
    number = np.maximum(sizes - length + 1, 0)
    suffixes, inner = ragged(begin, number)
    owner = np.repeat(np.arange(len(contents)), number)
    by, common = sorted_suffixes(data, suffixes, sizes[owner] - inner, length)
    place, owner, inner = suffixes[by], owner[by], inner[by]
    doc, at = docs[owner], starts[owner] + inner
    number = np.unique(docs, return_inverse=True)[1]
    age = np.unique(number[owner] * (at.max(initial=0) + 1) + at, return_inverse=True)[1]
    before = np.where(inner > 0, data[np.maximum(place - 1, 0)].astype(np.int64), -1)
    repeats, again = common_intervals(common, before, age, length)
    hit = np.flatnonzero(again)
    return (doc[hit], at[hit], at[hit] + again[hit]), repeats, (doc, at)


def _surrounding_batches(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Rows come in the order of their key; chunks end between keys."""
    held: list[tuple] = []
    rows = 0

    def flush(key, doc, start, content):
        many = np.concatenate(([False], key[1:] == key[:-1]))
        many |= np.concatenate((key[1:] == key[:-1], [False]))
        if not many.any():
            return None
        chosen = np.flatnonzero(many)
        texts = [content[i] for i in chosen.tolist()]
        (d, s, e), _, _ = compare_surroundings(key[chosen], doc[chosen], start[chosen], texts, length)
        docs, number = np.unique(d, return_inverse=True)
        r, s, e = _merge(number.astype(np.int64), s, e)
        return pa.record_batch({"doc": pa.array(docs[r]), "start": pa.array(s), "size": pa.array(e - s)})

    def joined():
        parts = list(zip(*held, strict=True))
        return [np.concatenate(p) for p in parts[:3]] + [[c for p in parts[3] for c in p]]

    for batch in batches:
        arrays = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "doc", "start")]
        held.append((*arrays, batch.column("content").to_pylist()))
        rows += batch.num_rows
        if rows < CHUNK_ROWS:
            continue
        key, doc, start, content = joined()
        cuts = np.flatnonzero(key[1:] != key[:-1]) + 1
        done = 0
        while len(cuts) and rows - done >= CHUNK_ROWS:
            ahead = cuts[(cuts > done) & (cuts <= max(done + CHUNK_ROWS, cuts[cuts > done].min(initial=rows)))]
            if not len(ahead):
                break
            to = int(ahead[-1])
            out = flush(key[done:to], doc[done:to], start[done:to], content[done:to])
            if out is not None:
                yield out
            done = to
        held = [(key[done:], doc[done:], start[done:], content[done:])]
        rows -= done
    if rows:
        out = flush(*joined())
        if out is not None:
            yield out


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc``, ``start``, ``size``: byte spans of ``docs`` (doc_id, text) that together cover each byte
    in a string of ``length`` bytes that also starts earlier.  Spans may overlap."""
    schema = "gram long, around long, doc long, place long"
    anchors = docs.mapInArrow(lambda b: _anchor_batches(b, length), schema)
    by_gram = Window.partitionBy("gram")
    seen = anchors.withColumns(
        {
            "previous": F.lag("around").over(by_gram.orderBy("around", "doc", "place")),
            "different": F.max("around").over(by_gram) != F.min("around").over(by_gram),
        }
    )
    run = F.col("place") < 0
    later = run | F.coalesce(F.col("previous") == F.col("around"), F.lit(False))
    kinds = seen.withColumn("later", later).where("later OR different")
    marks = stored(
        kinds.select("doc", F.abs("place").alias("place"), "later", F.when(~F.col("later"), F.col("gram")).alias("gram")),
        "anchors",
    )
    start = F.shiftright("place", SIZE_BITS + LEFT_BITS).alias("start")
    size = F.col("place").bitwiseAND(F.lit((1 << SIZE_BITS) - 1)).alias("size")
    left = F.shiftright("place", SIZE_BITS).bitwiseAND(F.lit((1 << LEFT_BITS) - 1)).cast("int")
    certain = marks.where("later").select("doc", start, size)

    unsure = marks.where("NOT later").select("doc", "gram", start, left.alias("left"), size.cast("int").alias("size"))
    wanted = unsure.groupBy("doc").agg(F.collect_list(F.struct("gram", "start", "left", "size")).alias("cuts"))
    texts = docs.select(F.col("doc_id").alias("doc"), F.col("text").cast("binary").alias("bytes"))
    cut = F.transform(
        "cuts",
        lambda c: F.struct(
            c["gram"].alias("gram"),
            c["start"].alias("start"),
            c["left"].alias("left"),
            F.substring(F.col("bytes"), c["start"].cast("int") + 1, c["size"]).alias("content"),
        ),
    )
    around = texts.join(wanted, "doc").select("doc", F.explode(cut).alias("c")).select("doc", "c.*")
    around = stored(around, "surroundings")
    # Two equal strings share the gram and at least half of the spare bytes on one of its sides.
    half = (length - GRAM + 1) // 2
    key_left = F.substring(F.col("content"), F.col("left") - half + 1, F.lit(GRAM + half))
    key_right = F.substring(F.col("content"), F.col("left") + 1, F.lit(GRAM + half))
    sides = F.array(
        F.when(
            F.col("left") >= half,
            F.struct(
                F.xxhash64(F.lit("left"), "gram", key_left).alias("key"),
                (F.col("left") - half).alias("begin"),
            ),
        ),
        F.when(
            F.length("content") - F.col("left") - GRAM >= half,
            F.struct(
                F.xxhash64(F.lit("right"), "gram", key_right).alias("key"),
                F.col("left").alias("begin"),
            ),
        ),
    )
    sided = around.select(F.explode(sides).alias("side"), "doc", "start", "content")
    # Strings with the bytes a key stands for go no further than this from them.
    low = F.greatest(F.lit(0), F.col("side.begin") + F.lit(GRAM + half - length))
    high = F.least(F.length("content"), F.col("side.begin") + F.lit(length))
    keyed = sided.where("side IS NOT NULL").where(high - low >= length).select(
        "side.key",
        (F.col("side.begin") - low).alias("begin"),
        "doc",
        (F.col("start") + low).alias("start"),
        F.substring(F.col("content"), low + 1, high - low).alias("content"),
    )
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("rows"))
    large = stored(sizes.where(F.col("rows") > CHUNK_ROWS).select("key"), "large")
    small = keyed.drop("begin")
    if large.limit(1).count():
        small = small.join(large, "key", "left_anti")
        certain = certain.union(
            stored(shared_strings(keyed.join(large, "key", "left_semi"), length, GRAM + half), "strings")
        )
    shared = F.count(F.lit(1)).over(Window.partitionBy("key"))
    grouped = small.withColumn("n", shared).where("n > 1").drop("n").sortWithinPartitions("key")
    found = grouped.mapInArrow(
        lambda b: _surrounding_batches(b, length), "doc long, start long, size long"
    )
    return certain.union(stored(found, "repeats"))


def shared_strings(keyed: DataFrame, length: int, held: int) -> DataFrame:
    """Repeats within keys of any number of rows, as :func:`repeated_spans` gives them.

    Rows have ``key``, ``doc``, ``start``, ``content``, and ``begin``, the place in ``content`` of the
    ``held`` bytes equal in all rows of the key.  Every string of ``length`` bytes around these is a
    row of its own, known by a hash of 128 bits; the least origin of each comes from sums made before
    the shuffle, and all others are repeats.  Those of one row overlap, so they make one span.
    """
    first = F.greatest(F.lit(0), F.col("begin") + F.lit(held - length))
    last = F.least(F.col("begin"), F.length("content") - F.lit(length))
    places = keyed.where(first <= last).withColumn("skip", F.explode(F.sequence(first, last)))
    string = F.substring(F.col("content"), F.col("skip") + 1, F.lit(length))
    strings = places.select(
        "key",
        "doc",
        "start",
        (F.col("start") + F.col("skip")).alias("at"),
        F.xxhash64(string).alias("h"),
        F.xxhash64(F.lit("again"), string).alias("g"),
    )
    origin = F.struct("doc", "at")
    least = strings.groupBy("h", "g").agg(F.min(origin).alias("least"), F.max(origin).alias("most"))
    least = stored(least.where("least < most").select("h", "g", "least"), "least")
    later = strings.join(least, ["h", "g"]).where(origin > F.col("least"))
    spans = later.groupBy("key", "doc", "start").agg(F.min("at").alias("low"), F.max("at").alias("high"))
    return spans.select(
        "doc", F.col("low").alias("start"), (F.col("high") - F.col("low") + length).alias("size")
    )


def remove_repeats(docs: DataFrame, length: int = LENGTH, carried: Sequence[str] = ()) -> DataFrame:
    """Documents without the bytes of repeated strings: ``doc_id``, ``n_bytes``, ``n_removed``,
    ``n_spans``, ``kept``, the remaining bytes, and ``row``, a struct of the ``carried`` columns.

    A byte goes if a string of ``length`` bytes that holds it also starts earlier, in a smaller
    ``doc_id`` or the same document.  Strings are judged on the input and never cross documents.
    A null text counts as empty; rows without ``doc_id`` are left out; of rows with one
    ``doc_id`` the smallest text that isn't empty counts, and one row comes out.  An empty table gives an empty
    result.  Columns other than ``doc_id``, ``text`` and those carried are not read.
    """
    row = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in carried]).alias("row")
    texts = docs.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        row,
    )
    if texts.groupBy("doc_id").count().where("count > 1").limit(1).count():
        order = F.struct((F.col("text") == "").alias("empty"), "text")
        single = texts.groupBy("doc_id").agg(
            F.min_by("text", order).alias("text"), F.min_by("row", order).alias("row")
        )
        texts = stored(single, "texts")
    spans = repeated_spans(texts, length).groupBy("doc").agg(
        F.collect_list(F.struct("start", "size")).alias("spans")
    )
    joined = texts.join(spans, texts["doc_id"] == spans["doc"], "left")
    joined = joined.select("doc_id", "text", "row", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in blocks(batches, BLOCK_BYTES):
            lists = batch.column("spans")
            number = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(batch.num_rows), number)
            start, size = (x.to_numpy(zero_copy_only=False) for x in lists.flatten().flatten())
            row, start, end = _merge(row, start, start + size)
            depth = np.zeros(len(data) + 1, np.int32)
            np.add.at(depth, offsets[row] + start, 1)
            np.add.at(depth, offsets[row] + end, -1)
            keep = np.cumsum(depth[:-1]) == 0
            gone = np.bincount(row, end - start, batch.num_rows).astype(np.int64)
            left = data[keep].tobytes()
            ends = np.concatenate(([0], np.cumsum(np.diff(offsets) - gone))).tolist()
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_bytes": pa.array(np.diff(offsets)),
                    "n_removed": pa.array(gone),
                    "n_spans": pa.array(np.bincount(row, minlength=batch.num_rows), pa.int64()),
                    "kept": pa.array(
                        [left[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary()
                    ),
                    "row": batch.column("row"),
                }
            )

    schema = T.StructType.fromDDL(
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    ).add(joined.schema["row"])
    return joined.mapInArrow(cut, schema)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: texts without repeated bytes; a character cut in two is replaced.

    Texts left empty stay as empty documents; ``n_chars`` becomes the length of the new text.  Rows
    without ``doc_id`` go, and of rows with one id that of the smallest text that isn't empty stays.
    """
    others = [c for c in docs.columns if c not in ("text", "n_chars", "doc_id")]
    kept = remove_repeats(docs, carried=others).withColumn(
        "kept", F.make_valid_utf8(F.col("kept").cast("string"))
    )
    new = {
        "doc_id": F.col("doc_id"),
        "text": F.col("kept"),
        "n_chars": F.length("kept").cast("long"),
    }
    return kept.select(*[new[c].alias(c) if c in new else F.col(f"row.`{c}`") for c in docs.columns])


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op4_repeats": op4_repeats}
SQL: dict[str, str] = {}
