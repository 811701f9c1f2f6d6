"""Toxicity: a bidirectional gated recurrent network with attention over words and their letters."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.llm.language import distinct_words, lexicon_rows, lowered, word_features, word_spans
from weekloom.llm.quality import held_out
from weekloom.llm.texts import blocks, ragged

#: Labelled documents of either kind the network is fitted on, at most.
TRAIN_ROWS = 1_200
THRESHOLD = 0.7
#: Words of a window, and the words from one window's start to the next: each word but the first and last
#: few is in two windows, and any phrase of up to nine words is whole in one.
WINDOW, STRIDE = 16, 8
#: Sizes of word vectors, letter vectors and recurrent states.
WORD_SIZE, LETTER_SIZE, STATE = 8, 8, 8
#: Buckets of letter n-grams; a word's letter input is the mean of its n-grams' vectors.
BUCKETS = 1 << 13
#: Words in so many training documents have a vector of their own; others share one.
LEXICON_COUNT = 3
STEPS, MINIBATCH, STEP = 400, 512, 0.02
#: Share of a minibatch drawn from toxic documents' windows.
TOXIC_SHARE = 0.25
#: After so many steps, and again after every REFRESH, only the BEST_WINDOWS scored highest
#: count for a toxic document.
WARM, REFRESH, BEST_WINDOWS = 200, 100, 2
#: One in so many training documents is set aside to calibrate the documents' scores.
CALIBRATION = 5
#: Steps between two looks at the documents set aside.
JUDGE = 50
BLOCK_BYTES = 1 << 20


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def new_weights(words: int, seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    size = WORD_SIZE + LETTER_SIZE
    draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
    weights = {
        "words": rng.normal(0, 0.05, (words + 1, WORD_SIZE)).astype(np.float32),
        "letters": rng.normal(0, 0.05, (BUCKETS, LETTER_SIZE)).astype(np.float32),
        "attend": draw(2 * STATE, 1)[:, 0],
        "out": draw(2 * STATE, 1)[:, 0],
        "bias": np.zeros(1, np.float32),
    }
    for side in ("f", "b"):
        weights[f"in_{side}"] = draw(size, 3 * STATE)
        weights[f"in_bias_{side}"] = np.zeros(3 * STATE, np.float32)
        weights[f"gates_{side}"] = draw(STATE, 2 * STATE)
        weights[f"new_{side}"] = draw(STATE, STATE)
    return weights


def _run_gru(projected: np.ndarray, mask: np.ndarray, gates: np.ndarray, new: np.ndarray, keep: bool):
    """States after each step (steps x windows x STATE), and what the way back needs.

    Steps outside a window leave its state as it is.
    """
    steps, n = mask.shape
    h = np.zeros((n, STATE), np.float32)
    states, tape = np.empty((steps, n, STATE), np.float32), []
    for t in range(steps):
        x = projected[t]
        zr = _sigmoid(x[:, : 2 * STATE] + h @ gates)
        z, r = zr[:, :STATE], zr[:, STATE:]
        rh = r * h
        c = np.tanh(x[:, 2 * STATE :] + rh @ new)
        on = mask[t][:, None]
        after = h + on * z * (c - h)
        if keep:
            tape.append((h, z, r, rh, c, on))
        states[t] = h = after
    return states, tape


def _back_gru(slopes: np.ndarray, tape, gates: np.ndarray, new: np.ndarray):
    """Gradients of projected inputs, gate weights and candidate weights."""
    steps, n, _ = slopes.shape
    d_x = np.empty((steps, n, 3 * STATE), np.float32)
    d_gates, d_new = np.zeros_like(gates), np.zeros_like(new)
    d_h = np.zeros((n, STATE), np.float32)
    for t in range(steps - 1, -1, -1):
        h, z, r, rh, c, on = tape[t]
        d_after = d_h + slopes[t]
        d_step = d_after * on
        d_c = d_step * z * (1 - c * c)
        d_rh = d_c @ new.T
        d_zr = np.concatenate([d_step * (c - h) * z * (1 - z), d_rh * h * r * (1 - r)], axis=1)
        d_h = d_after - d_step * z + d_rh * r + d_zr @ gates.T
        d_gates += h.T @ d_zr
        d_new += rh.T @ d_c
        d_x[t, :, : 2 * STATE], d_x[t, :, 2 * STATE :] = d_zr, d_c
    return d_x, d_gates, d_new


def score_windows(table: np.ndarray, windows: np.ndarray, w: dict, labels=None, counts=None):
    """Probability of each window; with ``labels`` also the gradients of all weights but vectors.

    ``table`` has the input vector of each distinct word; ``windows`` their numbers (windows x
    steps, -1 behind the end).
    """
    train = labels is not None
    numbers = windows.T
    mask = (numbers >= 0).astype(np.float32)
    at = np.maximum(numbers, 0)
    states, tapes = [], []
    for side, turn in (("f", slice(None)), ("b", slice(None, None, -1))):
        projected = table @ w[f"in_{side}"] + w[f"in_bias_{side}"]
        found, tape = _run_gru(projected[at[turn]], mask[turn], w[f"gates_{side}"], w[f"new_{side}"], train)
        states.append(found[turn])
        tapes.append(tape)
    h = np.concatenate(states, axis=2)
    logits = np.where(mask > 0, h @ w["attend"], -1e9)
    weight = np.exp(logits - logits.max(axis=0))
    weight *= mask
    weight /= np.maximum(weight.sum(axis=0), 1e-9)
    pooled = np.einsum("tn,tnk->nk", weight, h)
    p = _sigmoid(pooled @ w["out"] + w["bias"][0])
    if not train:
        return p
    d = ((p - labels) * counts / counts.sum()).astype(np.float32)
    grads = {"out": pooled.T @ d, "bias": np.array([d.sum()], np.float32)}
    d_pooled = d[:, None] * w["out"]
    share = np.einsum("nk,tnk->tn", d_pooled, h)
    d_logit = weight * (share - (weight * share).sum(axis=0))
    grads["attend"] = np.einsum("tn,tnk->k", d_logit, h)
    d_h = weight[:, :, None] * d_pooled + d_logit[:, :, None] * w["attend"]
    d_table = np.zeros_like(table)
    flat = at.ravel()
    for side, turn, tape, part in (
        ("f", slice(None), tapes[0], d_h[:, :, :STATE]),
        ("b", slice(None, None, -1), tapes[1], d_h[:, :, STATE:]),
    ):
        d_x, d_gates, d_new = _back_gru(part[turn], tape, w[f"gates_{side}"], w[f"new_{side}"])
        rows = d_x[turn].reshape(-1, 3 * STATE)
        summed = np.stack([np.bincount(flat, col, len(table)) for col in rows.T], 1).astype(np.float32)
        grads[f"gates_{side}"], grads[f"new_{side}"] = d_gates, d_new
        grads[f"in_{side}"] = table.T @ summed
        grads[f"in_bias_{side}"] = summed.sum(axis=0)
        d_table += summed @ w[f"in_{side}"].T
    return p, grads, d_table


def cut_windows(codes: np.ndarray, counts: np.ndarray):
    """Windows of WINDOW words every STRIDE words of each row with words: numbers, and their rows.

    The last window of a row holds its last word; every word is in a window.
    """
    number = np.where(counts > 0, 1 + np.maximum(0, -(-(counts - WINDOW) // STRIDE)), 0)
    rows = np.repeat(np.arange(len(counts)), number)
    inner = np.arange(len(rows)) - np.repeat(np.cumsum(number) - number, number)
    begin = (np.cumsum(counts) - counts)[rows] + inner * STRIDE
    size = np.minimum(WINDOW, counts[rows] - inner * STRIDE)
    steps = np.arange(WINDOW)
    inside = steps < size[:, None]
    at = np.where(inside, begin[:, None] + steps, 0)
    return np.where(inside, codes[at], -1) if len(codes) else np.full(at.shape, -1), rows


def calibration_inputs(highest: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = np.clip(highest, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p)), np.log(number)


def calibrate(
    highest: np.ndarray, number: np.ndarray, toxic: np.ndarray, weight: np.ndarray
) -> tuple[float, float, float]:
    """Logistic regression of labels on the highest window's logit and the number of windows.

    More windows give a clean document more chances of a high one.  ``weight`` restores the
    shares that labels have outside the sample.  Newton's steps with a small penalty towards the
    window score itself.
    """
    x = np.stack([np.ones(len(toxic)), *calibration_inputs(highest, number)], 1)
    prior = np.array([0.0, 1.0, 0.0])
    beta = prior.copy()
    for _ in range(25):
        p = _sigmoid(x @ beta)
        slope = x.T @ (weight * (toxic - p)) - (beta - prior)
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.eye(3)
        move = np.linalg.solve(curve, slope)
        beta += move * min(1.0, 2.0 / max(np.abs(move).max(), 1e-12))
    beta[1] = max(beta[1], 0.05)
    return tuple(float(b) for b in beta)


@dataclass(frozen=True)
class Network:
    weights: dict[str, np.ndarray]
    lexicon: np.ndarray  # sorted hashes of words with vectors of their own
    base: float  # the score of a text without words
    scale: tuple[float, float, float] = (0.0, 1.0, 0.0)  # calibration, see calibrate()

    def vectors(self, data, starts, lengths, hashes) -> np.ndarray:
        """The input of each word: its own vector beside the mean of its letter vectors."""
        buckets, bounds = word_features(data, starts, lengths)
        letters = self.weights["letters"][buckets % BUCKETS]
        mean = np.add.reduceat(letters, bounds[:-1]) / np.diff(bounds)[:, None].astype(np.float32)
        return np.concatenate([self.weights["words"][lexicon_rows(self.lexicon, hashes)], mean], 1)

    def calibrated(self, highest: np.ndarray, number: np.ndarray) -> np.ndarray:
        """A document's score from its highest window score and its number of windows."""
        logit, longer = calibration_inputs(highest, number)
        shift, slope, length = self.scale
        return _sigmoid(np.clip(shift + slope * logit + length * longer, -30, 30))

    def scores(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Highest window score of each text, where that window starts, and the windows' number."""
        data, offsets = lowered(texts)
        n = len(texts)
        best, place, number = np.full(n, self.base), np.zeros(n, np.int64), np.zeros(n, np.int64)
        starts, lengths, rows = word_spans(data, offsets)
        if len(starts) == 0:
            return best, place, number
        hashes, first, codes = distinct_words(data, starts, lengths)
        table = self.vectors(data, starts[first], lengths[first], hashes)
        windows, owner = cut_windows(codes, np.bincount(rows, minlength=n))
        p = score_windows(table, windows, self.weights).astype(float)
        number = np.bincount(owner, minlength=n)
        begin = np.cumsum(number) - number
        some = number > 0
        best[some] = self.calibrated(np.maximum.reduceat(p, begin[some]), number[some])
        highest = np.zeros(n)
        highest[some] = np.maximum.reduceat(p, begin[some])
        hit = np.flatnonzero(p >= highest[owner])[::-1]
        place[owner[hit]] = (hit - begin[owner[hit]]) * STRIDE
        return best, place, number


def constant_network(base: float, seed: int) -> Network:
    weights = new_weights(0, seed)
    weights["out"][:] = 0
    weights["bias"][:] = np.log(base / (1 - base))
    return Network(weights, np.zeros(0, np.uint64), base)


def fit_network(
    texts: list[str], toxic: np.ndarray, toxic_share: float | None = None, seed: int = 11
) -> Network:
    """Fit by Adam on overlapping windows; every window starts with its document's label.

    After WARM steps a toxic document counts by its BEST_WINDOWS only: what is toxic need not
    fill the document.  One in CALIBRATION documents is kept out, to choose among
    the weights on the way and to calibrate the documents' scores.  With labels of one kind, or none, every text gets the share of toxic labels (one
    half without labels).  ``toxic_share`` is the share of toxic documents outside the sample.
    """
    base = float((toxic.sum() + 0.5) / (len(toxic) + 1))
    toxic_share = base if toxic_share is None else toxic_share
    data, offsets = lowered(pa.array(texts, pa.string()))
    starts, lengths, rows = word_spans(data, offsets)
    if len(starts) == 0 or len(np.unique(toxic)) < 2:
        return constant_network(base, seed)
    hashes, first, codes = distinct_words(data, starts, lengths)
    in_documents = pd.DataFrame({"row": rows, "code": codes}).drop_duplicates()["code"]
    lexicon = np.sort(hashes[np.bincount(in_documents, minlength=len(hashes)) >= LEXICON_COUNT])
    lexicon_at = lexicon_rows(lexicon, hashes)
    buckets, bounds = word_features(data, starts[first], lengths[first])
    buckets %= BUCKETS
    sizes = np.diff(bounds)
    w = new_weights(len(lexicon), seed)
    windows, owner = cut_windows(codes, np.bincount(rows, minlength=len(texts)))
    label = toxic[owner].astype(np.float32)
    apart = np.zeros(len(texts), bool)
    if min(toxic.sum(), len(toxic) - toxic.sum()) >= 2 * CALIBRATION:
        for value in (0, 1):
            apart[np.flatnonzero(toxic == value)[::CALIBRATION]] = True
    clean = np.flatnonzero((label == 0) & ~apart[owner])
    toxic_windows = np.flatnonzero((label == 1) & ~apart[owner])
    momenta = {k: np.zeros_like(v) for k, v in w.items()}
    squares = {k: np.zeros_like(v) for k, v in w.items()}
    squares["words"] = squares["letters"] = np.zeros(1)
    rng = np.random.default_rng(seed)

    def inputs(words: np.ndarray):
        where, _ = ragged(bounds[:-1][words], sizes[words])
        mean = np.add.reduceat(w["letters"][buckets[where]], np.cumsum(sizes[words]) - sizes[words])
        mean /= sizes[words][:, None].astype(np.float32)
        return np.concatenate([w["words"][lexicon_at[words]], mean], 1), where

    def scored(which: np.ndarray, block: int = 4096) -> np.ndarray:
        out = [np.zeros(0, np.float32)]
        for at in range(0, len(which), block):
            taken = windows[which[at : at + block]]
            words, place = np.unique(taken, return_inverse=True)
            table, _ = inputs(np.maximum(words, 0))
            part = np.where(taken < 0, -1, place.reshape(-1, WINDOW))
            out.append(score_windows(table, part, w))
        return np.concatenate(out)

    if not len(clean) or not len(toxic_windows):
        return constant_network(base, seed)
    seen = np.flatnonzero(apart[owner])

    def judged() -> tuple[float, tuple[float, float, float]]:
        """Loss and calibration on the documents set aside."""
        frame = pd.DataFrame({"owner": owner[seen], "p": scored(seen)}).groupby("owner")["p"]
        highest, number = frame.max(), frame.size()
        is_toxic = toxic[highest.index] == 1
        share = np.where(is_toxic, toxic_share, 1 - toxic_share)
        share = share / np.where(is_toxic, is_toxic.mean(), 1 - is_toxic.mean())
        share /= share.mean()
        logit, longer = calibration_inputs(highest.to_numpy(float), number.to_numpy(float))
        found = calibrate(highest.to_numpy(float), number.to_numpy(float), is_toxic, share)
        p = _sigmoid(found[0] + found[1] * logit + found[2] * longer).clip(1e-6, 1 - 1e-6)
        return float(-(share * np.log(np.where(is_toxic, p, 1 - p))).mean()), found

    kept, scale, least = w, (0.0, 1.0, 0.0), np.inf
    best = toxic_windows
    toxic_size = int(TOXIC_SHARE * MINIBATCH)
    for step in range(1, STEPS + 1):
        if step > WARM and (step - WARM) % REFRESH == 1:
            frame = pd.DataFrame({"owner": owner[toxic_windows], "p": scored(toxic_windows)})
            rank = frame.groupby("owner")["p"].rank(ascending=False, method="first").to_numpy()
            best = toxic_windows[rank <= BEST_WINDOWS]
        chosen = np.concatenate(
            [rng.choice(best, toxic_size), rng.choice(clean, MINIBATCH - toxic_size)]
        )
        words, place = np.unique(windows[chosen], return_inverse=True)
        table, where = inputs(np.maximum(words, 0))
        part = np.where(windows[chosen] < 0, -1, place.reshape(-1, WINDOW))
        counts = np.ones(len(chosen), np.float32)
        _, grads, d_table = score_windows(table, part, w, label[chosen], counts)
        words = np.maximum(words, 0)
        spread = np.repeat(np.arange(len(words)), sizes[words])
        d_mean = d_table[:, WORD_SIZE:] / sizes[words][:, None]
        touched = {"words": np.unique(lexicon_at[words]), "letters": np.unique(buckets[where])}
        for name, key, slope in (
            ("words", lexicon_at[words], d_table[:, :WORD_SIZE]),
            ("letters", buckets[where], d_mean[spread]),
        ):
            index = np.searchsorted(touched[name], key)
            size = len(touched[name])
            grads[name] = np.stack([np.bincount(index, c, size) for c in slope.T], 1)
        for name, g in grads.items():
            at = touched.get(name, slice(None))
            m = momenta[name][at] = 0.9 * momenta[name][at] + 0.1 * g
            # one scale for a whole table of vectors: words seen often move further
            square = (g * g).mean() if name in touched else g * g
            squares[name] = s = 0.99 * squares[name] + 0.01 * square
            fixed = np.sqrt(s / (1 - 0.99**step)) + 1e-7
            w[name][at] -= (STEP * m / (1 - 0.9**step) / fixed).astype(np.float32)
        if len(seen) and step % JUDGE == 0:  # the weights that judge unseen documents best stay
            loss, found = judged()
            if loss < least:
                kept, scale, least = {k: v.copy() for k, v in w.items()}, found, loss
    return Network(kept, lexicon, base, scale)


def score_toxicity(
    docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, threshold: float = THRESHOLD
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted``, ``n_windows`` and ``worst_word``.

    A text's score is that of its highest window, ``worst_word`` the number of that window's
    first word (from 0); all overlapping windows of the whole text are scored.  Texts without
    words, null texts among them, get the share of toxic documents in training.  The network
    learns from at most ``train_rows`` documents of either label whose CRC-32 of the id mod 3
    is not 1.  Rows without ``doc_id`` are left out, repeated rows come out as often, a doubly
    labelled document counts by its greater label.  Other columns are not read.
    """
    out = held_out(F.col("doc_id"), 3, 1)
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    known = known.where(~out & F.col("toxic").isin(0, 1))
    counts = {row["toxic"]: row["count"] for row in known.groupBy("toxic").count().collect()}
    toxic_share = (counts.get(1, 0) + 0.5) / (counts.get(0, 0) + counts.get(1, 0) + 1)
    chosen = None
    for value in (0, 1):
        part = known.where(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
        chosen = part if chosen is None else chosen.union(part)
    rows = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), "text")
    sample = (
        rows.join(F.broadcast(chosen), "doc_id")  # at most 2 * train_rows ids
        .groupBy("doc_id", "toxic")
        .agg(F.min("text").alias("text"))
        .toPandas()
        .sort_values("doc_id")
    )
    texts = [t or "" for t in sample["text"]]
    network = fit_network(texts, sample["toxic"].to_numpy(float), toxic_share)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, _ in blocks(batches, BLOCK_BYTES):
            found, place, number = network.scores(batch.column("text"))
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "score": pa.array(found),
                    "n_windows": pa.array(number, pa.int64()),
                    "worst_word": pa.array(place, pa.int64()),
                }
            )

    scored = rows.mapInArrow(score, "doc_id long, score double, n_windows long, worst_word long")
    return scored.select(
        "doc_id",
        out.alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "n_windows",
        "worst_word",
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {"op6_toxicity": op6_toxicity}
SQL: dict[str, str] = {}
