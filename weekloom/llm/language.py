"""Language identification: a linear-chain conditional random field labels every word."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weekloom.llm.quality import held_out
from weekloom.llm.texts import blocks, mix, ragged, span_hashes, spans, utf8

#: Labelled documents the field is fitted on, at most; chosen by a hash of the id.
TRAIN_ROWS = 400
#: Rows of the weight table that prefixes, suffixes and n-grams are hashed to.
BUCKETS = 1 << 17
#: Lengths in bytes of n-grams and of the affixes that are features of their own.
NGRAMS, AFFIXES = (1, 2, 3, 4), (2, 3, 4)
#: Words seen so often in training have a lexicon feature.
LEXICON_COUNT = 3
#: Words of one training sequence; its two halves come from two places.
SEQUENCE = 32
EPOCHS, STEP, DECAY = 18, 0.15, 1e-4
#: Words of a chain whose transfer matrices are multiplied at once.
CHUNK = 64
#: Bytes of text handled at once.
BLOCK_BYTES = 1 << 20
UNKNOWN = "und"

_LETTER = np.zeros(256, bool)
_LETTER[list(range(0x41, 0x5B)) + list(range(0x61, 0x7B)) + list(range(0x80, 0x100))] = True


def lowered(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the texts in lower case."""
    return utf8(pa.array([(t or "").lower() for t in texts.to_pylist()], pa.large_string()))


def word_spans(data: np.ndarray, offsets: np.ndarray):
    """Runs of letters: starts, lengths, rows.  Bytes of non-ASCII characters count as letters.

    A row whose runs hold no letter at all, as Unicode has it, has no words.
    """
    starts, lengths, rows = spans(_LETTER[data], offsets)
    ascii_letters = np.zeros(len(offsets), np.int64)
    np.cumsum(np.bincount(rows, minlength=len(offsets) - 1), out=ascii_letters[1:])
    plain = np.add.accumulate(np.concatenate(([0], (_LETTER[data] & (data < 0x80)).astype(np.int64))))
    unsure = (plain[offsets[1:]] == plain[offsets[:-1]]) & (np.diff(ascii_letters) > 0)
    if unsure.any():
        bad = [
            r
            for r in np.flatnonzero(unsure)
            if not any(c.isalpha() for c in data[offsets[r] : offsets[r + 1]].tobytes().decode())
        ]
        keep = ~np.isin(rows, bad)
        starts, lengths, rows = starts[keep], lengths[keep], rows[keep]
    return starts, lengths, rows


def distinct_words(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
    """Hashes of the distinct words, the place of one of each, and each word's number among them."""
    hashes = span_hashes(data, starts, lengths)
    codes, found = pd.factorize(hashes)
    first = np.zeros(len(found), np.int64)
    first[codes[::-1]] = np.arange(len(codes))[::-1]
    return found.astype(np.uint64), first, codes


def word_features(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
    """Hashed n-gram and affix features of words: buckets, and the offsets of each word's.

    A word stands between two boundary bytes; an affix is the n-gram at either end, once more.
    """
    where, inner = ragged(starts - 1, lengths + 2)
    wide = lengths + 2
    size = np.repeat(wide, wide)
    last = inner == size - 1
    values = np.where((inner == 0) | last, 1, data[np.clip(where, 0, max(len(data) - 1, 0))])
    values = values.astype(np.uint64) + np.uint64(1)
    word = np.repeat(np.arange(len(starts)), wide)
    buckets, owners = [], []
    rolled = np.zeros(len(values), np.uint64)
    for n in range(1, max(*NGRAMS, *AFFIXES) + 1):
        rolled = rolled[: len(values) - n + 1] * np.uint64(0x100000001B3) + values[n - 1 :]
        at = np.arange(len(rolled))
        whole = inner[: len(rolled)] + n <= size[: len(rolled)]
        for wanted, kind, which in (
            (n in NGRAMS, 0, whole & ((n > 1) | ~((inner == 0) | last)[: len(rolled)])),
            (n in AFFIXES, 1, whole & (inner[: len(rolled)] == 0)),
            (n in AFFIXES, 2, whole & (inner[: len(rolled)] + n == size[: len(rolled)])),
        ):
            if wanted:
                picked = at[which]
                salt = np.uint64((n * 4 + kind) * 0x9E3779B1)
                buckets.append(mix(rolled[picked] + salt) % np.uint64(BUCKETS))
                owners.append(word[picked])
    buckets, owners = np.concatenate(buckets).astype(np.int64), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    counts = np.bincount(owners, minlength=len(starts))
    return buckets[order], np.concatenate(([0], np.cumsum(counts)))


def forward_backward(scores: np.ndarray, lengths: np.ndarray, transfer: np.ndarray):
    """Posterior of each word's label in chains laid one after another.

    ``scores`` are emission factors (words x labels, positive); ``transfer`` is the matrix of
    transition factors.  Chains are cut into chunks; the products of the transfer matrices of
    all chunks are formed together, their ends are passed along each chain, then all chunks run
    forwards and backwards together.  The result is exact for chains of any length.
    """
    labels = scores.shape[1]
    pieces = -(-lengths // CHUNK)
    chunks = int(pieces.sum())
    chain = np.repeat(np.arange(len(lengths)), pieces)
    first_chunk = np.cumsum(pieces) - pieces
    begin = np.cumsum(lengths) - lengths
    number = np.arange(chunks) - first_chunk[chain]
    start = begin[chain] + number * CHUNK
    size = np.minimum(CHUNK, lengths[chain] - number * CHUNK)
    product = np.tile(np.eye(labels), (chunks, 1, 1))
    for t in range(int(size.max(initial=0))):
        on = np.flatnonzero(size > t)
        step = (product[on] @ transfer) * scores[start[on] + t][:, None, :]
        product[on] = step / step.sum(axis=(1, 2), keepdims=True)
    # what enters each chunk from the left, and from the right
    left = np.full((chunks, labels), 1.0 / labels)
    right = np.ones((chunks, labels))
    for k in range(1, int(pieces.max(initial=0))):
        on = first_chunk[pieces > k] + k
        moved = np.einsum("ci,cij->cj", left[on - 1], product[on - 1])
        left[on] = moved / moved.sum(axis=1, keepdims=True)
        on = (first_chunk + pieces - 1)[pieces > k] - k
        moved = np.einsum("cij,cj->ci", product[on + 1], right[on + 1])
        right[on] = moved / moved.sum(axis=1, keepdims=True)
    alpha = np.zeros_like(scores)
    beta = np.ones_like(scores)
    state = left.copy()
    for t in range(int(size.max(initial=0))):
        on = np.flatnonzero(size > t)
        step = (state[on] @ transfer) * scores[start[on] + t]
        step /= step.sum(axis=1, keepdims=True)
        state[on] = alpha[start[on] + t] = step
    state = right.copy()
    for t in range(int(size.max(initial=0))):
        on = np.flatnonzero(size > t)
        at = start[on] + size[on] - 1 - t
        beta[at] = state[on]
        step = (scores[at] * state[on]) @ transfer.T
        state[on] = step / step.sum(axis=1, keepdims=True)
    posterior = alpha * beta
    return posterior / posterior.sum(axis=1, keepdims=True), alpha, beta


@dataclass(frozen=True)
class Field:
    """Weights of a fitted field; ``labels`` are its languages in ascending order."""

    labels: list[str]
    weights: np.ndarray  # buckets x labels
    lexicon: np.ndarray  # sorted hashes of known words
    lexicon_weights: np.ndarray  # words x labels, a last row of zeros for unknown words
    transitions: np.ndarray  # labels x labels

    def emissions(self, data, starts, lengths, hashes) -> np.ndarray:
        buckets, bounds = word_features(data, starts, lengths)
        sums = np.add.reduceat(self.weights[buckets], bounds[:-1]) if len(starts) else np.zeros((0, len(self.labels)))
        return sums + self.lexicon_weights[lexicon_rows(self.lexicon, hashes)]


def lexicon_rows(lexicon: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The row of each hash; unknown ones get the row after the last."""
    if len(lexicon) == 0:
        return np.zeros(len(hashes), np.int64)
    at = np.minimum(np.searchsorted(lexicon, hashes), len(lexicon) - 1)
    return np.where(lexicon[at] == hashes, at, len(lexicon))


def _factors(scores: np.ndarray) -> np.ndarray:
    return np.exp(np.clip(scores - scores.max(axis=1, keepdims=True), -40, 0))


def fit_field(texts: list[str], langs: list[str], seed: int = 7) -> Field | None:
    """Fit emission and transition weights by maximum likelihood; None without labelled words.

    Every word carries its document's label.  Half of the training sequences join words of two
    documents, so that switches between languages occur and their weights are learnt.
    """
    data, offsets = lowered(pa.array(texts, pa.string()))
    starts, lengths, rows = word_spans(data, offsets)
    labels = sorted(set(langs))
    if not labels or len(starts) == 0:
        return None
    code = {lang: i for i, lang in enumerate(labels)}
    of_row = np.array([code[lang] for lang in langs])
    hashes, first, words = distinct_words(data, starts, lengths)
    buckets, bounds = word_features(data, starts[first], lengths[first])
    owner = np.repeat(np.arange(len(hashes)), np.diff(bounds))
    lexicon = np.sort(hashes[np.bincount(words) >= LEXICON_COUNT])
    lexicon_at = lexicon_rows(lexicon, hashes)

    # halves of sequences: runs of words of one document; short ends are kept as they are
    half = SEQUENCE // 2
    inner = np.arange(len(rows)) - np.searchsorted(rows, rows)
    cuts = np.flatnonzero(inner % half == 0)
    sizes = np.diff(np.append(cuts, len(rows)))
    rng = np.random.default_rng(seed)
    partner = np.arange(len(cuts))
    partner = np.where(rng.random(len(cuts)) < 0.5, np.roll(partner, -1), rng.permutation(len(cuts)))
    joined = np.stack([np.arange(len(cuts)), partner], 1).ravel()
    places, _ = ragged(cuts[joined], sizes[joined])
    chains = sizes + sizes[partner]
    word, gold = words[places], of_row[rows[places]]

    n = len(labels)
    weights = np.zeros((BUCKETS, n))
    known = np.zeros((len(lexicon) + 1, n))
    transitions = np.zeros((n, n))
    squares = [np.full_like(w, 1e-8) for w in (weights, known, transitions)]
    onehot = np.zeros((len(gold), n))
    onehot[np.arange(len(gold)), gold] = 1
    inside = np.ones(len(gold), bool)
    inside[np.cumsum(chains) - chains] = False  # the first word of a chain has no transition
    after = np.flatnonzero(inside)
    seen = np.bincount(gold[after - 1] * n + gold[after], minlength=n * n).reshape(n, n)
    total = len(gold)
    for _ in range(EPOCHS):
        emissions = np.add.reduceat(weights[buckets], bounds[:-1]) + known[lexicon_at]
        transfer = np.exp(transitions)
        factors = _factors(emissions)[word]
        posterior, alpha, beta = forward_backward(factors, chains, transfer)
        error = onehot - posterior
        by_word = np.stack([np.bincount(word, error[:, k], len(hashes)) for k in range(n)], 1)
        slopes = [
            np.stack([np.bincount(buckets, by_word[owner, k], BUCKETS) for k in range(n)], 1),
            np.stack([np.bincount(lexicon_at, by_word[:, k], len(known)) for k in range(n)], 1),
        ]
        ahead = factors[after] * beta[after]
        pair = alpha[after - 1][:, :, None] * transfer * ahead[:, None, :]
        slopes.append(seen - (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0))
        slopes[1][-1] = 0
        for w, square, slope in zip((weights, known, transitions), squares, slopes, strict=True):
            slope = slope / total - DECAY * w / len(w)
            square += slope**2
            w += STEP * slope / np.sqrt(square)
    return Field(labels, weights.astype(np.float32), lexicon, known, transitions)


def label_languages(docs: DataFrame, field: Field | None) -> DataFrame:
    """Languages of whole texts: ``doc_id``, ``lang_pred``, ``score``, ``n_words``,
    ``n_switches`` (neighbouring words labelled differently) and ``word_langs`` (words by label).

    The document's language has the greatest mean posterior over its words, ties going to the
    first in the alphabet; that mean is the score.  Texts that are null or hold no letter are
    ``und`` with score 0, and so are all texts if nothing could be learnt.
    """
    schema = "doc_id long, lang_pred string, score double, n_words long, n_switches long, word_langs map<string,long>"

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transfer = None if field is None else np.exp(field.transitions)
        kind = pa.map_(pa.string(), pa.int64())
        for batch, _, _ in blocks(batches, BLOCK_BYTES):
            data, offsets = lowered(batch.column("text"))
            n = batch.num_rows
            starts, lengths, rows = word_spans(data, offsets)
            counts = np.bincount(rows, minlength=n)
            pred, score = np.full(n, UNKNOWN, object), np.zeros(n)
            switches = np.zeros(n, np.int64)
            shares = [{} for _ in range(n)]
            if field is not None and len(starts):
                hashes, first, words = distinct_words(data, starts, lengths)
                emitted = field.emissions(data, starts[first], lengths[first], hashes)
                chains = counts[counts > 0]
                posterior, _, _ = forward_backward(_factors(emitted)[words], chains, transfer)
                k = len(field.labels)
                mean = np.stack([np.bincount(rows, posterior[:, i], n) for i in range(k)], 1)
                mean /= np.maximum(counts, 1)[:, None]
                best = posterior.argmax(axis=1)
                by_label = np.bincount(rows * k + best, minlength=n * k).reshape(n, k)
                changed = (best[1:] != best[:-1]) & (rows[1:] == rows[:-1])
                switches = np.bincount(rows[1:][changed], minlength=n)
                some = counts > 0
                top = mean.argmax(axis=1)
                pred = np.where(some, np.array(field.labels, object)[top], UNKNOWN)
                score = np.where(some, np.clip(mean[np.arange(n), top], 0, 1), 0.0)
                shares = [
                    {lang: int(c) for lang, c in zip(field.labels, row, strict=True) if c}
                    for row in by_label
                ]
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "lang_pred": pa.array(pred, pa.string()),
                    "score": pa.array(score),
                    "n_words": pa.array(counts, pa.int64()),
                    "n_switches": pa.array(switches, pa.int64()),
                    "word_langs": pa.array([list(s.items()) for s in shares], kind),
                }
            )

    rows = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(label, schema)


def identify_languages(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Languages by a field learnt from the documents' own labels; see :func:`label_languages`.

    It is fitted on at most ``train_rows`` documents with a language whose CRC-32 of the id mod 5
    is not 0 (one row of each id, its smallest language counting), dealt to the languages in turn, and
    on one of every language however many there are.  Rows without ``doc_id`` are left out, repeated rows come out as often, an empty
    table gives an empty result.  Other columns are not read.
    """
    out = held_out(F.col("doc_id"), 5, 0)
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~out)
    ids = known.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("lang").alias("lang"))
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ranked = ids.withColumn("_n", F.row_number().over(by_hash)).where(F.col("_n") <= train_rows)
    dealt = ranked.orderBy("_n", F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    chosen = dealt.union(ranked.where("_n = 1")).select("doc_id", "lang").distinct()
    sample = known.join(F.broadcast(chosen), ["doc_id", "lang"]).select("doc_id", "text", "lang")
    sample = sample.dropDuplicates(["doc_id"]).toPandas().sort_values("doc_id")
    field = fit_field(sample["text"].tolist(), sample["lang"].tolist())
    return label_languages(docs, field).withColumn("held_out", out).select(
        "doc_id", "held_out", "lang_pred", "score", "n_words", "n_switches", "word_langs"
    )


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op1_language": op1_language}
SQL: dict[str, str] = {}
