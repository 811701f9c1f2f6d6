"""SentencePiece encoding and decoding by matching all pieces in a suffix array of the batch."""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.llm.texts import blocks, ragged

#: A model of the BPE kind with byte fallback and no normalisation.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Runs of spaces with what follows them up to the next space or line end; no piece reaches
#: beyond such a run, so each is encoded on its own.
UNITS = re.compile("▁+[^▁\n]*|[^▁\n]+|\n+")
#: Units of more characters are merged one by one with a heap, all others together.
LONG_UNIT = 64
BLOCK_BYTES = 1 << 22
#: The lowest and the highest bit of each of eight bytes.
_ONES, _TOPS = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)


@dataclass(frozen=True)
class Vocabulary:
    """The pieces of a model, by id, and the merging order."""

    data: np.ndarray  # bytes of all pieces, one after another
    starts: np.ndarray
    lengths: np.ndarray
    rank: np.ndarray  # 0 is merged first
    normal: np.ndarray  # ids that can be matched in a text
    byte_ids: np.ndarray  # id of each byte value
    text_data: np.ndarray  # bytes that ids stand for when decoded
    text_starts: np.ndarray
    text_lengths: np.ndarray


@lru_cache(maxsize=2)
def load_vocabulary(path: str) -> Vocabulary:
    """Read a model's pieces.  Only BPE models whose units UNITS separates are accepted."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    pieces = [model.id_to_piece(i) for i in range(size)]
    special = np.array(
        [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(size)]
    )
    byte = np.array([model.is_byte(i) for i in range(size)])
    normal = np.flatnonzero(~special & ~byte)
    for i in normal:
        if SPACE in pieces[i].lstrip(SPACE) or "\n" in pieces[i]:
            raise ValueError(f"a piece spans words: {pieces[i]!r}")
    byte_ids = np.full(256, model.unk_id())
    for i in np.flatnonzero(byte):
        byte_ids[int(pieces[i][3:5], 16)] = i
    scores = np.array([model.get_score(i) for i in range(size)])
    order = np.lexsort((np.arange(size), -scores))
    rank = np.empty(size, np.int64)
    rank[order] = np.arange(size)
    found = [p.encode() for p in pieces]
    spelled = [
        bytes([int(p[3:5], 16)]) if b else b"" if s else p.replace(SPACE, " ").encode()
        for p, b, s in zip(pieces, byte, special, strict=True)
    ]

    def packed(parts: list[bytes]):
        lengths = np.array([len(p) for p in parts])
        return np.frombuffer(b"".join(parts), np.uint8), np.cumsum(lengths) - lengths, lengths

    return Vocabulary(*packed(found), rank, normal, byte_ids, *packed(spelled))


def sort_suffixes(data: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """``starts`` in the order of the ``depth`` bytes there, eight at a time.

    Only suffixes still equal and without a zero byte so far are compared further: units are
    closed by zeros, which no piece reaches beyond.  ``data`` must end in ``depth`` + 8 zero bytes.
    """
    wide = data.astype(np.uint64)
    key = wide[: len(data) - 7].copy()
    for i in range(1, 8):
        key = (key << np.uint64(8)) | wide[i : len(data) - 7 + i]
    order = starts.copy()
    live, group = np.arange(len(order)), np.zeros(len(order), np.int64)
    for width in range(0, depth, 8):
        if not len(live):
            break
        value = key[order[live] + width]
        by = np.lexsort((value, group)) if width else np.argsort(value)
        order[live], value = order[live[by]], value[by]
        fresh = np.concatenate(([True], (group[1:] != group[:-1]) | (value[1:] != value[:-1])))
        group = np.cumsum(fresh) - 1
        closed = (value - _ONES) & ~value & _TOPS != 0  # some byte is zero
        tied = (np.bincount(group)[group] > 1) & ~closed
        live, group = live[tied], group[tied]
    return order


def _compare(data, suffixes, pieces, starts, lengths) -> np.ndarray:
    """Sign of the first different byte of each suffix and piece; 0 if the piece is a prefix."""
    out = np.zeros(len(suffixes), np.int64)
    live = np.arange(len(suffixes))
    for i in range(int(lengths.max(initial=0))):
        live = live[(lengths[live] > i) & (out[live] == 0)]
        if not len(live):
            break
        out[live] = data[suffixes[live] + i].astype(np.int64) - pieces[starts[live] + i]
    return np.sign(out)


def match_pieces(data: np.ndarray, order: np.ndarray, vocab: Vocabulary, ids: np.ndarray):
    """The range of the sorted suffixes that begin with each piece: first and behind the last."""
    bounds = []
    for upper in (False, True):
        low, high = np.zeros(len(ids), np.int64), np.full(len(ids), len(order))
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_]) // 2
            which = ids[open_]
            sign = _compare(data, order[middle], vocab.data, vocab.starts[which], vocab.lengths[which])
            right = sign <= 0 if upper else sign < 0
            low[open_] = np.where(right, middle + 1, low[open_])
            high[open_] = np.where(right, high[open_], middle)
        bounds.append(low)
    return bounds


@dataclass(frozen=True)
class Edges:
    """All occurrences of pieces, sorted by place: key is place * width + length in bytes."""

    keys: np.ndarray
    ids: np.ndarray
    width: int

    def find(self, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The piece that spans exactly these bytes, or -1."""
        if len(self.keys) == 0:
            return np.full(len(starts), -1)
        keys = starts * self.width + lengths
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((self.keys[at] == keys) & (lengths < self.width), self.ids[at], -1)


def find_edges(data: np.ndarray, char_starts: np.ndarray, vocab: Vocabulary) -> Edges:
    """Match all pieces in ``data`` (distinct units, each closed by a zero byte)."""
    depth = int(vocab.lengths[vocab.normal].max())
    padded = np.concatenate([data, np.zeros(depth + 8, np.uint8)])
    order = sort_suffixes(padded, char_starts, depth)
    low, high = match_pieces(padded, order, vocab, vocab.normal)
    where, _ = ragged(low, high - low)
    ids = np.repeat(vocab.normal, high - low)
    keys = order[where] * (depth + 1) + vocab.lengths[ids]
    bits = len(vocab.rank).bit_length()  # a key and its id sort as one number
    packed = np.sort((keys << bits) | ids)
    return Edges(packed >> bits, packed & ((1 << bits) - 1), depth + 1)


def relax(starts: np.ndarray, lengths: np.ndarray, unit: np.ndarray, edges: Edges, vocab: Vocabulary):
    """Merge neighbouring symbols of each unit until no edge spans two of them.

    In each round every unit merges its pair of best rank, the leftmost of equals, as BPE does;
    pairs are looked up among the edges.  Symbols are given by place and length in bytes, in
    order; the symbols left are returned with their units.
    """
    done = []
    while len(starts):
        pair = np.full(len(starts), -1)
        inside = np.flatnonzero(unit[1:] == unit[:-1])
        pair[inside] = edges.find(starts[inside], lengths[inside] + lengths[inside + 1])
        rank = np.where(pair >= 0, vocab.rank[pair], len(vocab.rank))
        first = np.flatnonzero(np.concatenate(([True], unit[1:] != unit[:-1])))
        best = np.minimum.reduceat(rank, first)
        sizes = np.diff(np.append(first, len(unit)))
        ended = np.repeat(best == len(vocab.rank), sizes)
        done.append((starts[ended], lengths[ended], unit[ended]))
        go = np.flatnonzero(~ended)
        starts, lengths, unit, rank = starts[go], lengths[go], unit[go], rank[go]
        if not len(starts):
            break
        hit = np.flatnonzero(rank == np.repeat(best, sizes)[go])
        hit = hit[np.concatenate(([True], unit[hit][1:] != unit[hit][:-1]))]
        lengths[hit] += lengths[hit + 1]
        keep = np.ones(len(starts), bool)
        keep[hit + 1] = False
        starts, lengths, unit = starts[keep], lengths[keep], unit[keep]
    starts, lengths, unit = (np.concatenate([d[i] for d in done]) for i in range(3))
    order = np.argsort(starts)
    return starts[order], lengths[order], unit[order]


def relax_long(starts: list[int], lengths: list[int], edges: Edges, vocab: Vocabulary):
    """:func:`relax` for a single long unit, with a heap of pairs: n log n steps."""
    n = len(starts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    heap = []

    def push(lefts: list[int]) -> None:
        lefts = [i for i in lefts if 0 <= i and after[i] < n]
        if not lefts:
            return
        at = np.array([starts[i] for i in lefts])
        wide = np.array([lengths[i] + lengths[after[i]] for i in lefts])
        for i, size, piece in zip(lefts, wide.tolist(), edges.find(at, wide).tolist(), strict=True):
            if piece >= 0:
                heapq.heappush(heap, (int(vocab.rank[piece]), i, size))

    push(list(range(n - 1)))
    while heap:
        _, i, size = heapq.heappop(heap)
        if not alive[i] or after[i] >= n or lengths[i] + lengths[after[i]] != size:
            continue
        gone = after[i]
        alive[gone], lengths[i], after[i] = False, size, after[gone]
        if after[i] < n:
            before[after[i]] = i
        push([before[i], i])
    left = [i for i in range(n) if alive[i]]
    return [starts[i] for i in left], [lengths[i] for i in left]


def encode_units(units: list[str], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all units, one unit after another, and the offsets of each unit's ids."""
    spelled = [u.encode() for u in units]
    data = np.frombuffer(b"\0".join(spelled) + b"\0", np.uint8)
    sizes = np.array([len(u) for u in spelled], np.int64)
    begin = np.cumsum(sizes + 1) - sizes - 1
    in_unit, _ = ragged(begin, sizes)
    char_starts = in_unit[(data[in_unit] & 0xC0) != 0x80]
    edges = find_edges(data, char_starts, vocab)
    unit = np.searchsorted(begin, char_starts, "right") - 1
    ends = np.append(char_starts[1:], 0)
    last = np.append(unit[1:] != unit[:-1], True)
    ends = np.where(last, begin[unit] + sizes[unit], ends)
    lengths = ends - char_starts
    chars = np.bincount(unit, minlength=len(units))
    long = chars[unit] > LONG_UNIT
    parts = [relax(char_starts[~long], lengths[~long], unit[~long], edges, vocab)] if (~long).any() else []
    for u in np.flatnonzero(chars > LONG_UNIT):
        mine = unit == u if len(units) < 8 else slice(*np.searchsorted(unit, [u, u + 1]))
        s, n = relax_long(char_starts[mine].tolist(), lengths[mine].tolist(), edges, vocab)
        parts.append((np.array(s), np.array(n), np.full(len(s), u)))
    starts, lengths, unit = (np.concatenate([p[i] for p in parts]) for i in range(3))
    order = np.argsort(starts)
    starts, lengths, unit = starts[order], lengths[order], unit[order]
    ids = edges.find(starts, lengths)
    # a character without a piece becomes its bytes
    wide = np.where(ids >= 0, 1, lengths)
    out = np.repeat(ids, wide)
    bare = np.repeat(ids < 0, wide)
    place, _ = ragged(starts, wide)
    out[bare] = vocab.byte_ids[data[place[bare]]]
    counts = np.bincount(np.repeat(unit, wide), minlength=len(units))
    return out.astype(np.int32), np.concatenate(([0], np.cumsum(counts)))


def encode_batch(texts: list[str], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, one text after another, and offsets.

    A space is put before each text, spaces become ``▁``; the distinct units of the batch are
    encoded once and their ids copied to every place they stand in.
    """
    units, counts = [], np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        if text:
            found = UNITS.findall(SPACE + text.replace(" ", SPACE))
            counts[i] = len(found)
            units += found
    if not units:
        return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    table = pa.array(units, pa.large_string()).dictionary_encode()
    del units
    codes = table.indices.to_numpy()
    ids, bounds = encode_units(table.dictionary.to_pylist(), vocab)
    sizes = np.diff(bounds)[codes]
    where, _ = ragged(bounds[:-1][codes], sizes)
    ends = np.concatenate(([0], np.cumsum(sizes)))
    return ids[where], ends[np.concatenate(([0], np.cumsum(counts)))]


def decode_batch(ids: np.ndarray, offsets: np.ndarray, vocab: Vocabulary) -> list[bytes]:
    """The UTF-8 text of each row of ids; the space put before it is taken off."""
    sizes = vocab.text_lengths[ids]
    where, _ = ragged(vocab.text_starts[ids], sizes)
    data = vocab.text_data[where].tobytes()
    ends = np.concatenate(([0], np.cumsum(sizes)))[offsets].tolist()
    parts = (data[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True))
    return [p[1:] if p[:1] == b" " else p for p in parts]


def _shipped(spark: SparkSession, path: str) -> str:
    """Give executors the model file; they need no access to the driver's folders."""
    spark.sparkContext.addFile(path)
    return path.rpartition("/")[2]


def encode_texts(docs: DataFrame, model: str = MODEL, with_ids: bool = True) -> DataFrame:
    """Token ids of whole texts and what decoding them gives.

    ``doc_id``, ``ids`` (only ``with_ids``), ``n_tokens``, ``ids_sha256`` (lowercase hex, of the ids as
    little-endian 32-bit numbers), ``n_bytes`` and ``decoded_sha256`` (of the text decoded from the
    ids, as UTF-8) and ``exact`` (whether that is the text itself, which only a text that holds
    ``▁`` fails).  The ids are those of the SentencePiece library.  Null counts as empty; an empty
    text has no ids.  Rows without ``doc_id`` are left out, repeated rows come out as often; other
    columns are not read.
    """
    name = _shipped(docs.sparkSession, model)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = load_vocabulary(SparkFiles.get(name))
        for batch, data, offsets in blocks(batches, BLOCK_BYTES):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ids, bounds = encode_batch(texts, vocab)
            decoded = decode_batch(ids, bounds, vocab)
            raw = ids.astype("<i4").tobytes()
            ends = (bounds * 4).tolist()
            given = [data[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            columns = {
                "doc_id": batch.column("doc_id"),
                "n_tokens": pa.array(np.diff(bounds), pa.int64()),
                "ids_sha256": pa.array(
                    [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(ends[:-1], ends[1:], strict=True)]
                ),
                "n_bytes": pa.array([len(d) for d in decoded], pa.int64()),
                "decoded_sha256": pa.array([hashlib.sha256(d).hexdigest() for d in decoded]),
                "exact": pa.array([a == b for a, b in zip(given, decoded, strict=True)]),
            }
            if with_ids:
                values = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
                columns["ids"] = values
            yield pa.record_batch(columns)

    rows = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), "text")
    schema = (
        "doc_id long, n_tokens long, ids_sha256 string, n_bytes long, decoded_sha256 string,"
        " exact boolean" + (", ids array<int>" if with_ids else "")
    )
    return rows.mapInArrow(encode, schema)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last stage of the pipeline: token ids and digests of every row."""
    return encode_texts(docs)


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_texts(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_ids=False)


QUERIES = {"op9_pieces": op9_pieces}
SQL: dict[str, str] = {}
