"""Toxicity: a bidirectional gated recurrent network with attention pooling (operator 3).

A word enters the network as four parts: the log-odds of its hashed form, the largest log-odds of its
character n-grams, a learned vector of its hashed form, and the mean of learned vectors of its character
n-grams.  Two gated recurrent layers read a window of ``WINDOW`` words in both directions, attention
pools their states, and a logistic unit gives the window's score.  Windows start every ``STRIDE`` words,
so neighbours overlap, and all windows of a text are scored.  A document's score is that of its worst
window, mapped so that ``CUT`` is the best cut on rows kept from the fit.

Only fitting uses labels: at most ``PER_CLASS`` labelled texts of each class, never of the held-out fold.
The network is trained in numpy; scoring runs in the executors.  Language, source and ids are no inputs.

Defined cases: a missing or empty text has score 0; equal texts have equal scores; without labels of
both classes every score is 0; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from mlspark.llm.common import Words, arrow_map, crc_remainder, fit_in_task, labelled_sample, mix

WINDOW, STRIDE = 32, 24
CUT = 0.3
MODULUS, HELD_OUT = 4, 2
PER_CLASS = 2000
GRAMS = (4, 5)
ODDS_BITS, VECTOR_BITS = 19, 14  # buckets of log-odds, and the coarser ones of learned vectors
COARSE = ODDS_BITS - VECTOR_BITS
WIDTH, HIDDEN, ATTENTION = 4, 8, 8
INPUT = 2 + 2 * WIDTH
TURNS, STEPS, BATCH = 4, 60, 256
SMOOTHING = 5.0
CHUNK = 4096  # windows scored at once
PART = 1 << 15  # dictionary words described at once
CLEAN_PER_TOXIC = 8  # the share that the cut is set for; samples may hold fewer clean documents
BOS, EOS = 2, 3  # byte values that mark the ends of a word

Params = dict[str, np.ndarray]


@dataclass
class Lexicon:
    """Hashed parts of a dictionary of words."""

    word: np.ndarray  # bucket of each word
    grams: np.ndarray  # buckets of all character n-grams, word by word
    bounds: np.ndarray  # where each word's n-grams start

    @staticmethod
    def of(words: Words) -> Lexicon:
        """Built ``PART`` words at a time, so that temporary arrays stay small."""
        data, offsets = words.letters()
        word = (words.hashes() >> np.uint64(64 - ODDS_BITS)).astype(np.int64)
        grams, counts = [np.empty(0, np.int32)], [np.zeros(1, np.int64)]
        for at in range(0, len(word), PART):
            part = offsets[at : at + PART + 1]
            found, count = Lexicon.grams_of(data[part[0] : part[-1]], part - part[0])
            grams.append(found)
            counts.append(count)
        return Lexicon(word, np.concatenate(grams), np.cumsum(np.concatenate(counts)))

    @staticmethod
    def grams_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of the character n-grams of words, word by word, and their number per word."""
        sizes = np.diff(offsets)
        # each word between its two marks
        marked = np.zeros(len(data) + 2 * len(sizes), np.uint64)
        starts = offsets[:-1] + 2 * np.arange(len(sizes))
        place = np.arange(len(data)) + np.repeat(2 * np.arange(len(sizes)) + 1, sizes)
        marked[place], marked[starts], marked[starts + sizes + 1] = data, BOS, EOS
        owner = np.repeat(np.arange(len(sizes)), sizes + 2)
        found, owners = [], []
        for n in GRAMS:
            count = max(0, len(marked) - n + 1)
            same = owner[:count] == owner[n - 1 :][:count]
            code = np.full(count, n, np.uint64)
            for k in range(n):
                code = code * np.uint64(257) + marked[k : k + count]
            found.append((mix(code) >> np.uint64(64 - ODDS_BITS)).astype(np.int32)[same])
            owners.append(owner[:count][same])
        grams, owner = np.concatenate(found), np.concatenate(owners)
        return grams[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(sizes))

    def part(self, a: int, b: int) -> Lexicon:
        bounds = self.bounds[a : b + 1]
        return Lexicon(self.word[a:b], self.grams[bounds[0] : bounds[-1]], bounds - bounds[0])

    def spread(self, values: np.ndarray, combine: np.ufunc, coarse: int = 0) -> np.ndarray:
        """Combines the values of each word's n-grams; 0 for a word shorter than any n-gram."""
        out = np.zeros((len(self.word), *values.shape[1:]), values.dtype)
        has = self.bounds[1:] > self.bounds[:-1]
        if has.any():
            out[has] = combine.reduceat(values[self.grams >> coarse], self.bounds[:-1][has], axis=0)
        return out

    def inputs(self, p: Params) -> np.ndarray:
        """One input row per dictionary word."""
        n = len(self.word)
        if n > PART:
            return np.concatenate([self.part(at, min(at + PART, n)).inputs(p) for at in range(0, n, PART)])
        number = np.maximum(np.diff(self.bounds), 1)[:, None].astype(np.float32)
        return np.concatenate(
            [
                p["word_odds"][self.word][:, None],
                self.spread(p["gram_odds"], np.maximum)[:, None],
                p["word_vec"][self.word >> COARSE],
                self.spread(p["gram_vec"], np.add, COARSE) / number,
            ],
            axis=1,
        )


def windows(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length) of the windows of texts with these word counts; the last one reaches the end."""
    n = np.where(counts > 0, 1 + np.maximum(0, -(-(counts - WINDOW) // STRIDE)), 0)
    owner = np.repeat(np.arange(len(counts)), n)
    start = (np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)) * STRIDE
    return owner, start, np.minimum(WINDOW, counts[owner] - start)


def window_codes(words: Words, owner: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """(windows, WINDOW) word codes; places after the end hold the code one past the dictionary."""
    at = (words.starts[:-1][owner] + start)[:, None] + np.arange(WINDOW)
    codes = np.concatenate([words.codes, np.zeros(WINDOW, np.int64)])[np.minimum(at, len(words.codes))]
    return np.where(np.arange(WINDOW) < length[:, None], codes, len(words.dictionary)).astype(np.int32)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def run_layer(gates: np.ndarray, codes: np.ndarray, u: np.ndarray, b: np.ndarray, back: bool, keep: bool):
    """States of one gated recurrent layer; ``gates`` holds the input's share of the gates per word."""
    n, steps, h = codes.shape[0], codes.shape[1], HIDDEN
    states = np.zeros((steps, n, h), np.float32)
    state, trace = np.zeros((n, h), np.float32), []
    pad = len(gates) - 1
    for t in reversed(range(steps)) if back else range(steps):
        x, own = gates[codes[:, t]], state @ u + b
        zr = sigmoid(x[:, : 2 * h] + own[:, : 2 * h])
        z, r = zr[:, :h], zr[:, h:]
        new = np.tanh(x[:, 2 * h :] + r * own[:, 2 * h :])
        on = (codes[:, t] != pad)[:, None]
        after = np.where(on, new + z * (state - new), state)
        if keep:
            trace.append((t, state, z, r, new, own[:, 2 * h :], on))
        state = states[t] = after
    return states, trace


def forward(p: Params, inputs: np.ndarray, codes: np.ndarray, keep: bool = False):
    """Logit of each window; ``inputs`` has one row per dictionary word."""
    padded = np.concatenate([inputs, np.zeros((1, INPUT), np.float32)])
    runs = [run_layer(padded @ p[f"w{d}"], codes, p[f"u{d}"], p[f"b{d}"], d == 1, keep) for d in (0, 1)]
    states = np.concatenate([runs[0][0], runs[1][0]], axis=2)
    hidden = np.tanh(states @ p["aw"] + p["ab"])
    energy = np.where((codes != len(inputs)).T, hidden @ p["av"], -1e9)
    weight = np.exp(energy - energy.max(axis=0))
    weight /= weight.sum(axis=0)
    pooled = np.einsum("tn,tnh->nh", weight, states)
    logit = pooled @ p["ow"] + p["ob"]
    return (logit, (padded, states, hidden, weight, pooled, runs)) if keep else logit


def backward(p: Params, lexicon: Lexicon, codes: np.ndarray, cache, d_logit: np.ndarray) -> Params:
    """Gradients of the loss with respect to every parameter that is learned."""
    padded, states, hidden, weight, pooled, runs = cache
    h, g = HIDDEN, {}
    g["ow"], g["ob"] = pooled.T @ d_logit, np.array([d_logit.sum()], np.float32)
    d_pooled = d_logit[:, None] * p["ow"]
    d_weight = np.einsum("nh,tnh->tn", d_pooled, states)
    d_states = weight[:, :, None] * d_pooled
    d_energy = weight * (d_weight - (weight * d_weight).sum(axis=0))
    g["av"] = np.einsum("tn,tna->a", d_energy, hidden)
    d_hidden = d_energy[:, :, None] * p["av"] * (1 - hidden**2)
    g["aw"] = np.einsum("tnh,tna->ha", states, d_hidden)
    g["ab"] = d_hidden.sum(axis=(0, 1))
    d_states += d_hidden @ p["aw"].T
    d_inputs = np.zeros_like(padded)
    for d in (0, 1):
        u = p[f"u{d}"]
        gu, gb = np.zeros_like(u), np.zeros_like(p[f"b{d}"])
        d_gates = np.zeros((len(padded), 3 * h), np.float32)
        carry = np.zeros((codes.shape[0], h), np.float32)
        for t, before, z, r, new, own, on in reversed(runs[d][1]):
            d_after = d_states[t, :, d * h : (d + 1) * h] + carry
            live = np.where(on, d_after, 0)
            d_new = live * (1 - z) * (1 - new**2)
            d_x = np.concatenate([live * (before - new) * z * (1 - z), d_new * own * r * (1 - r), d_new], axis=1)
            d_own = np.concatenate([d_x[:, : 2 * h], d_new * r], axis=1)
            gu += before.T @ d_own
            gb += d_own.sum(axis=0)
            np.add.at(d_gates, codes[:, t], d_x)
            carry = d_own @ u.T + live * z + np.where(on, 0, d_after)
        g[f"u{d}"], g[f"b{d}"] = gu, gb
        g[f"w{d}"] = padded.T @ d_gates
        d_inputs += d_gates @ p[f"w{d}"].T
    d_words = d_inputs[:-1]
    g["word_vec"] = np.zeros_like(p["word_vec"])
    np.add.at(g["word_vec"], lexicon.word >> COARSE, d_words[:, 2 : 2 + WIDTH])
    n = np.diff(lexicon.bounds)
    share = d_words[:, 2 + WIDTH :] / np.maximum(n, 1)[:, None]
    g["gram_vec"] = np.zeros_like(p["gram_vec"])
    np.add.at(g["gram_vec"], lexicon.grams >> COARSE, np.repeat(share, n, axis=0))
    return g


def odds(buckets: np.ndarray, positive: np.ndarray, negative: np.ndarray, n: tuple[int, int], size: int) -> np.ndarray:
    """Log-odds of a bucket among toxic and clean documents, drawn to 0 by ``SMOOTHING`` documents; 0 where never seen."""
    pos = np.bincount(buckets, positive, minlength=size)
    neg = np.bincount(buckets, negative, minlength=size)
    share = (n[1] + 1) / (n[0] + n[1] + 2)
    value = np.log((pos + SMOOTHING * share) / (neg + SMOOTHING * (1 - share))) - np.log(share / (1 - share))
    return np.clip(value, -8, 8).astype(np.float32)


def odds_tables(words: Words, lexicon: Lexicon, labels: np.ndarray, docs: np.ndarray) -> Params:
    """Log-odds of word and n-gram buckets from the document counts of words in the documents flagged in ``docs``."""
    pairs = np.unique(words.codes * np.int64(len(labels)) + words.owners())
    code, owner = pairs // len(labels), pairs % len(labels)
    counts = [np.bincount(code[docs[owner] & (labels[owner] == k)], minlength=len(words.dictionary)) for k in (0, 1)]
    n = (int((docs & (labels == 0)).sum()), int((docs & (labels == 1)).sum()))
    grams = [np.repeat(c, np.diff(lexicon.bounds)) for c in counts]
    return {
        "word_odds": odds(lexicon.word, counts[1], counts[0], n, 1 << ODDS_BITS),
        "gram_odds": odds(lexicon.grams, grams[1], grams[0], n, 1 << ODDS_BITS),
    }


def initial(rng: np.random.Generator) -> Params:
    def make(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    p = {"word_vec": make(1 << VECTOR_BITS, WIDTH, scale=0.05), "gram_vec": make(1 << VECTOR_BITS, WIDTH, scale=0.05)}
    for d in (0, 1):
        p |= {f"w{d}": make(INPUT, 3 * HIDDEN, scale=0.3), f"u{d}": make(HIDDEN, 3 * HIDDEN, scale=0.3)}
        p[f"b{d}"] = np.zeros(3 * HIDDEN, np.float32)
    p |= {"aw": make(2 * HIDDEN, ATTENTION, scale=0.3), "ab": np.zeros(ATTENTION, np.float32), "av": make(ATTENTION, scale=0.3)}
    return p | {"ow": make(2 * HIDDEN, scale=0.3), "ob": np.zeros(1, np.float32)}


def train(given: list[int], texts: pa.Array | pa.ChunkedArray, seed: int = 7) -> Params | None:
    """Fits the network on labels and texts; None without both classes."""
    labels = np.array(given, dtype=np.int64)
    if len(np.unique(labels)) < 2:
        return None
    rng = np.random.default_rng(seed)
    words = Words(texts, lower=True)
    lexicon = Lexicon.of(words)
    # a fifth of the rows sets the cut; the odds that a row sees in training never come from its own half
    part = rng.permutation(len(labels)) % 10
    held = part < 2
    halves = [odds_tables(words, lexicon, labels, ~held & (part % 2 == k)) for k in (0, 1)]
    owner, start, length = windows(words.counts)
    codes = window_codes(words, owner, start, length)
    p = initial(rng) | halves[0]
    seen = part[owner] % 2  # a row of one half sees the other half's odds
    told = [np.append(lexicon.inputs(p | half)[:, :2].sum(axis=1), -np.inf).astype(np.float32) for half in halves]
    telling = np.where(seen == 0, told[1][codes].max(axis=1), told[0][codes].max(axis=1))
    target = labels[owner].astype(np.float32)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items() if not k.endswith("odds")}
    step, rows = 0, np.empty(0, np.int64)
    for turn in range(TURNS):
        if turn:
            # the windows that the network itself finds worst: of clean texts they are its mistakes
            views = [lexicon.inputs(p | halves[1 - half]) for half in (0, 1)]
            for half in (0, 1):
                mine = np.flatnonzero(seen == half)
                for at in range(0, len(mine), CHUNK):
                    telling[mine[at : at + CHUNK]] = forward(p, views[half], codes[mine[at : at + CHUNK]])
        best = np.lexsort((-telling, owner))
        worst = best[np.unique(owner[best], return_index=True)[1]]
        other = rng.permutation(len(owner))
        other = other[np.unique(owner[other], return_index=True)[1]]
        clean = np.concatenate([rows, worst, other])
        rows = np.unique(np.concatenate([worst[labels[owner[worst]] == 1], clean[labels[owner[clean]] == 0]]))
        rows = rows[~held[owner[rows]]]
        order = np.empty(0, np.int64)
        for _ in range(STEPS):
            step += 1
            if len(order) < BATCH:
                order = np.concatenate([order, rng.permutation(rows)])
            chosen, order = order[:BATCH], order[BATCH:]
            total: Params = {}
            for half in (0, 1):
                mine = chosen[seen[chosen] == half]
                if not len(mine):
                    continue
                used, local = np.unique(codes[mine], return_inverse=True)
                local = local.reshape(len(mine), WINDOW)
                small = used[used < len(words.dictionary)]  # the padding code sorts last and stays one past the end
                n = np.diff(lexicon.bounds)[small]
                flat = np.repeat(lexicon.bounds[:-1][small] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                own = Lexicon(lexicon.word[small], lexicon.grams[flat], np.concatenate([[0], np.cumsum(n)]))
                q = p | halves[1 - half]
                logit, cache = forward(q, own.inputs(q), local, keep=True)
                error = (sigmoid(logit) - target[mine]) / len(chosen)
                for k, v in backward(q, own, local, cache, error.astype(np.float32)).items():
                    total[k] = total[k] + v if k in total else v
            rate = 0.01 * min(1.0, step / 20)
            for k, grad in total.items():
                m, v = moments[k]
                m += 0.1 * (grad - m)
                v += 0.01 * (grad**2 - v)
                p[k] = p[k] - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    p |= odds_tables(words, lexicon, labels, ~held)
    worst = worst_logits(p, words)
    p["scale"] = best_cut(worst[held], labels[held])
    return p


def best_cut(logits: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """(cut, slope): the logit that separates the classes best by F1, in the middle of its gap."""
    order = np.sort(np.unique(logits))
    if len(order) < 2 or len(np.unique(labels)) < 2:
        return np.array([0.0, 1.0])
    middles = (order[1:] + order[:-1]) / 2
    weight = CLEAN_PER_TOXIC * (labels == 1).sum() / (labels == 0).sum()
    f1 = []
    for cut in middles:
        hit, false = ((logits >= cut) & (labels == 1)).sum(), ((logits >= cut) & (labels == 0)).sum()
        f1.append(2 * hit / max(1, hit + weight * false + (labels == 1).sum()))
    top = np.flatnonzero(np.array(f1) >= max(f1) - 1e-12)
    return np.array([float(middles[top[len(top) // 2]]), 1.0])


def worst_logits(p: Params, words: Words) -> np.ndarray:
    """Largest window logit of each text; -inf for a text without words.  All windows are scored."""
    owner, start, length = windows(words.counts)
    worst = np.full(len(words.counts), -np.inf)
    if len(owner):
        lexicon = Lexicon.of(words)
        inputs = lexicon.inputs(p)
        for at in range(0, len(owner), CHUNK):
            part = slice(at, at + CHUNK)
            codes = window_codes(words, owner[part], start[part], length[part])
            np.maximum.at(worst, owner[part], forward(p, inputs, codes).astype(np.float64))
    return worst


def score(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    return apply(docs, fit(docs, labels, per_class))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Params | None:
    """Trains on the bounded sample, in one task."""
    return fit_in_task(labelled_sample(docs, labels, "toxic", MODULUS, HELD_OUT, per_class), train)


def document_scores(p: Params | None, texts: pa.Array) -> np.ndarray:
    """Score of each text, rounded so that it does not depend on how rows are batched."""
    if p is None:
        return np.zeros(len(texts))
    cut, slope = p["scale"]
    logits = slope * (worst_logits(p, Words(texts, lower=True)) - cut) + math.log(CUT / (1 - CUT))
    value = np.round(1 / (1 + np.exp(-np.clip(logits, -50, 50))), 6)
    value[np.isneginf(logits)] = 0.0
    return value


def apply(docs: DataFrame, model: Params | None) -> DataFrame:
    """Scores every whole text with a fitted network."""
    names = ["doc_id", "held_out", "score", "predicted"]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        value = document_scores(shared.value, batch.column("text"))
        predicted = (value >= CUT).astype(np.int32)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(value), pa.array(predicted)], names)

    folds = docs.select("doc_id", "text", (crc_remainder("doc_id", MODULUS) == HELD_OUT).alias("held_out"))
    return arrow_map(folds, run, "doc_id long, held_out boolean, score double, predicted int")


def keep_clean(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """The rows whose score stays below the cut, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, per_class))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield batch.filter(pa.array(document_scores(shared.value, batch.column("text")) < CUT))

    return arrow_map(docs, run, docs.schema)
