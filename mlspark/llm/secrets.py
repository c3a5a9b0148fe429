"""Secret scans: a random forest over candidate strings (operator 9).

Candidates are unbroken runs of at least ``SHORTEST`` characters of the alphabets that keys are written
in, strings of a known key format, lines of private key blocks, and values of any length and alphabet
that are assigned to a credential name.  Each is described by its length, character classes and their
transitions, entropy, how much of it dictionary words cover, whether it is part of a path or address, and
the words beside it.  A forest trained from labelled findings removes false positives.

Without given findings there are four sources of labels.  Known formats, key blocks and assigned values
are true; addresses, plain numbers and plain words are false; all else is unlabelled and takes no part in
the fit.  The features that hold the words before a candidate (``CUES``) are then left out, so the forest
judges the string itself; what the first three sources name is a secret whatever the forest says.

The dictionary counts the words of all texts, and the forest is fitted on all findings; every whole text is
scanned.  Up to ``PER_CLASS`` findings of each class are fitted with exact splits at once, more of them with Spark's
distributed forest, which splits between bins of a feature's values.

Defined cases: a missing or empty text has no candidates; without findings of both classes every
candidate counts as a secret if one of the sources names it; equal texts give equal findings; an empty table
gives no rows; other columns are ignored, or kept as they are by ``redact``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mlspark.llm.common import arrow_map
from mlspark.session import written

SHORTEST = 16
RUN = re.compile(r"[A-Za-z0-9+/_=.\-]{%d,}" % SHORTEST)
CREDENTIAL = r"(?:token|secret|passw(?:or)?d|pwd|api[_-]?key|access[_-]?key|private[_-]?key|auth|bearer|credential)"
NAMED = re.compile(CREDENTIAL, re.IGNORECASE)
ASSIGNED = re.compile(CREDENTIAL + r"\w*[\"']?\s*(?:[=:]|=>|\s)\s*[\"']?$", re.IGNORECASE)
NAME = (
    r"(?<![a-z])(?:token|secret|passw(?:or)?d|passphrase|pwd|api[_-]?key|access[_-]?key|private[_-]?key|auth(?!or|en)|bearer|credential)"
    r"[\w-]{0,40}"
)
VALUE = re.compile(
    NAME + r"[\"']?\s{0,8}(?:=>|[=:])\s{0,8}(?:\"([^\"\s]+)\"|'([^'\s]+)'|`([^`\s]+)`|([^\s\"'`,;&|<>()\[\]{}]+))", re.IGNORECASE
)
FORMATS = re.compile(
    r"(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|github_pat_\w{22,}|glpat-[\w-]{20,}|xox[abprs]-[A-Za-z0-9-]{10,}"
    r"|[sr]k_(?:live|test)_[A-Za-z0-9]{16,}|AIza[\w-]{35}|eyJ[\w-]{8,}\.eyJ[\w-]{8,}\.[\w-]+)(?![A-Za-z0-9])"
)
BLOCK = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----(.*?)(?:-----END|\Z)", re.DOTALL)
BLOCK_LINE = re.compile(r"[A-Za-z0-9+/=]{4,}")
STAND_IN = re.compile(r"[$%]?[{<(].*|(.)\1*|none|null|true|false|.*://.*", re.IGNORECASE | re.DOTALL)
BEFORE, AFTER = 48, 24
DICTIONARY_WORDS = 5000
PER_CLASS = 4000  # a class with more findings is fitted by Spark's forest, and weighs as much as so many
TREES, DEPTH, LEAF, BINS = 25, 7, 4, 128
CUT = 0.5
MASK = "[SECRET]"
FEATURES = (
    "length transitions entropy digits upper lower hex_only even_hex dictionary slashes dots address quoted assigned "
    "named_before numbers_before letters_before letters_after"
).split()
CUES = [FEATURES.index(name) for name in "quoted assigned named_before numbers_before letters_before".split()]


def dictionary(docs: DataFrame) -> frozenset[str]:
    """The words of four letters or more that most texts hold, of those that three texts hold."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for text in batch.column("text").to_pylist():
            counts.update(set(re.findall(r"[a-z]{4,12}", (text or "").lower())))
        yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

    counts = arrow_map(docs.filter("doc_id is not null").select("text"), run, "word string, n long")
    common = counts.groupBy("word").agg(F.sum("n").alias("n")).filter("n >= 3").orderBy(F.desc("n"), "word").limit(DICTIONARY_WORDS)
    return frozenset(r["word"] for r in common.collect())


def covered(letters: str, words: frozenset[str]) -> float:
    """Share of the string that dictionary words cover, longest first from the left."""
    at, hit = 0, 0
    while at < len(letters) - 3:
        size = next((n for n in range(min(12, len(letters) - at), 3, -1) if letters[at : at + n] in words), 0)
        hit += size
        at += size or 1
    return hit / max(1, len(letters))


def describe(text: str, start: int, end: int, words: frozenset[str]) -> list[float]:
    """The values of ``FEATURES`` for one candidate."""
    run = text[start:end]
    before, after = text[max(0, start - BEFORE) : start], text[end : end + AFTER]
    n = len(run)
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "o" for c in run]
    share = Counter(kinds)
    counts = np.array(list(Counter(run).values())) / n
    hexes = re.fullmatch(r"[0-9a-fA-F]+", run) is not None
    last = before.split()[-2:]
    return [
        float(n),
        sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / n,
        float(-(counts * np.log2(counts)).sum()),
        share["d"] / n,
        share["u"] / n,
        share["l"] / n,
        float(hexes),
        float(hexes and n in (32, 40, 48, 56, 64, 96, 128)),
        covered(re.sub(r"[^a-z]", "", run.lower()), words),
        run.count("/") / n,
        run.count(".") / n,
        float("://" in before[-12:] or before.endswith("@") or after.startswith("@")),
        float(before[-1:] in "\"'`" and before[-1:] != ""),
        float(re.search(r"[=:]\s*[\"'`]?$", before) is not None),
        float(any(NAMED.search(w) for w in before.split()[-3:])),
        float(sum(c.isdigit() for w in last for c in w)),
        float(sum(c.isalpha() for w in last for c in w)),
        float(sum(c.isalpha() for c in after[:16])),
    ]


def evident(text: str) -> list[tuple[int, int]]:
    """Spans of known key formats, of lines in private key blocks, and of values assigned to a credential name."""
    spans = [m.span() for m in FORMATS.finditer(text)]
    if "PRIVATE KEY-----" in text:
        for block in BLOCK.finditer(text):
            spans += [m.span() for m in BLOCK_LINE.finditer(text, *block.span(1))]
    for m in VALUE.finditer(text):
        start, end = m.span(m.lastindex)
        if m.lastindex == 4:
            # without quotes, a sentence may go on: the value ends before its full stop and is more than a word
            end -= len(m.group(4)) - len(m.group(4).rstrip(".:!?"))
            if text[start:end].isalpha() and (end - start < SHORTEST or plain(text[start:end])):
                continue
        if end > start and not STAND_IN.fullmatch(text, start, end):
            spans.append((start, end))
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans, key=lambda s: (s[0], -s[1])):
        if not out or start >= out[-1][1]:
            out.append((start, end))
    return out


def candidates(text: str | None) -> list[tuple[int, int]]:
    """Code point spans of candidate strings, evident ones first where they overlap; dots at either end belong to the sentence."""
    return [(a, b) for a, b, _ in marked_candidates(text or "")]


def marked_candidates(text: str) -> list[tuple[int, int, bool]]:
    """(start, end, whether it is evident) of all candidates; what is left of a run beside an evident span is a run again."""
    sure = evident(text)
    spans = [(a, b, True) for a, b in sure]
    k = 0
    for m in RUN.finditer(text):
        while k < len(sure) and sure[k][1] <= m.start():
            k += 1
        at, pieces, j = m.start(), [], k
        while j < len(sure) and sure[j][0] < m.end():
            pieces.append((at, sure[j][0]))
            at = max(at, sure[j][1])
            j += 1
        for a, b in [*pieces, (at, m.end())]:
            run = text[a:b]
            start, end = a + len(run) - len(run.lstrip(".-/")), b - len(run) + len(run.rstrip(".-/"))
            if end - start >= SHORTEST and any(c.isalnum() for c in run):
                spans.append((start, end, False))
    return sorted(spans)


def named(text: str, start: int) -> int:
    """1 if the candidate is assigned to a credential name."""
    return int(ASSIGNED.search(text[max(0, start - BEFORE) : start]) is not None)


def plain(run: str) -> bool:
    """Whether the string is words: letters in lower or upper case, or with a capital, between signs."""
    return all(not w or (w.isalpha() and (w[1:].islower() or w.isupper() or len(w) == 1)) for w in re.split(r"[+/_=.\-]", run))


def source_label(text: str, start: int, end: int, sure: bool) -> int | None:
    """1 for evident candidates, 0 for addresses, plain numbers and plain words, None for what no source decides."""
    run, before = text[start:end], text[max(0, start - BEFORE) : start]
    words = plain(run)
    if sure or (named(text, start) and not words and any(c.isdigit() for c in run)):
        return 1
    numbers = re.fullmatch(r"[0-9+/_=.\-]+", run) is not None
    address = before.endswith(("://", "://www.", "@")) or text[end : end + 1] == "@"
    return 0 if words or numbers or address else None


@dataclass
class Tree:
    """A binary tree in arrays; a leaf has feature -1."""

    feature: np.ndarray
    cut: np.ndarray
    below: np.ndarray  # child for values up to the cut; the other child follows it
    value: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        for _ in range(DEPTH):
            f = self.feature[node]
            step = x[np.arange(len(x)), np.maximum(f, 0)] > self.cut[node]
            node = np.where(f < 0, node, self.below[node] + step)
        return self.value[node]


def best_split(x: np.ndarray, y: np.ndarray, features: np.ndarray) -> tuple[float, int, float]:
    """(gain, feature, cut) with the largest fall of Gini impurity."""
    best = (1e-12, -1, 0.0)
    n, total = len(y), y.sum()
    whole = total * (n - total) / n
    for f in features:
        order = np.argsort(x[:, f], kind="stable")
        v, hits = x[order, f], np.cumsum(y[order])[:-1]
        size = np.arange(1, n)
        ok = (v[1:] > v[:-1]) & (size >= LEAF) & (n - size >= LEAF)
        if not ok.any():
            continue
        rest = total - hits
        impurity = hits * (size - hits) / size + rest * (n - size - rest) / (n - size)
        gain = np.where(ok, whole - impurity, -1)
        at = int(gain.argmax())
        if gain[at] > best[0]:
            best = (float(gain[at]), int(f), float((v[at] + v[at + 1]) / 2))
    return best


def grow(x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> Tree:
    """One tree on a bootstrap sample, with a random third of the features at every split."""
    rows = rng.integers(0, len(y), len(y))
    feature, cut, below, value = [-1], [0.0], [0], [0.0]
    todo = [(0, rows, 0)]
    while todo:
        node, rows, depth = todo.pop()
        value[node] = float(y[rows].mean())
        if depth == DEPTH or value[node] in (0.0, 1.0) or len(rows) < 2 * LEAF:
            continue
        chosen = rng.permutation(x.shape[1])[: max(1, x.shape[1] // 3)]
        _, f, at = best_split(x[rows], y[rows], chosen)
        if f < 0:
            continue
        feature[node], cut[node], below[node] = f, at, len(feature)
        high = x[rows, f] > at
        for part in (rows[~high], rows[high]):
            todo.append((len(feature), part, depth + 1))
            feature.append(-1)
            cut.append(0.0)
            below.append(0)
            value.append(0.0)
    return Tree(np.array(feature), np.array(cut), np.array(below), np.array(value))


def spark_forest(rows: DataFrame, sizes: dict[int, int], per_class: int, seed: int) -> list[Tree]:
    """Trees on all rows (x, y), grown by Spark.  A class weighs as its rows, but at most as ``per_class`` of them.

    The variance of labels 0 and 1 is half their Gini impurity, so trees of a regression split as ``grow`` does,
    and their leaves hold the share of true rows.
    """
    weight = F.when(F.col("y") == 1, min(1.0, per_class / sizes[1])).otherwise(min(1.0, per_class / sizes[0]))
    data = rows.select(array_to_vector("x").alias("features"), F.col("y").cast("double").alias("label"), weight.alias("weight"))
    forest = RandomForestRegressor(
        numTrees=TREES, maxDepth=DEPTH, minInstancesPerNode=LEAF, maxBins=BINS, featureSubsetStrategy="onethird", weightCol="weight", seed=seed
    ).fit(data)
    return [printed_tree(tree.toDebugString) for tree in forest.trees]


def printed_tree(printed: str) -> Tree:
    """A tree of Spark's forest from its printed lines."""
    lines = iter(printed.splitlines()[1:])
    feature, cut, below, value = [-1], [0.0], [0], [0.0]

    def read(node: int) -> None:
        line = next(lines).strip()
        if line.startswith("Predict:"):
            value[node] = float(line.split(":")[1])
            return
        index, at = re.match(r"If \(feature (\d+) <= (\S+)\)", line).groups()
        first = len(feature)
        feature[node], cut[node], below[node] = int(index), float(at), first
        for column, empty in ((feature, -1), (cut, 0.0), (below, 0), (value, 0.0)):
            column.extend([empty, empty])
        read(first)
        next(lines)  # the matching Else
        read(first + 1)

    read(0)
    return Tree(np.array(feature), np.array(cut), np.array(below), np.array(value))


@dataclass
class Forest:
    words: frozenset[str]
    trees: list[Tree]
    weak: bool = False  # fitted without given findings: the sources decide first, and the forest does not see their cues

    def scores(self, text: str, spans: list[tuple[int, int]]) -> np.ndarray:
        """Probability of each candidate of one text."""
        marks = {(a, b): sure for a, b, sure in marked_candidates(text)} if self.weak or not self.trees else {}
        named_ones = np.array([source_label(text, a, b, marks.get((a, b), False)) == 1 for a, b in spans] if marks else [False] * len(spans))
        if not self.trees:
            return named_ones.astype(float)
        x = np.array([describe(text, a, b, self.words) for a, b in spans])
        if self.weak:
            x[:, CUES] = 0
        return np.where(named_ones, 1.0, np.mean([t.predict(x) for t in self.trees], axis=0))


def weak_findings(docs: DataFrame) -> DataFrame:
    """(text, spans): the candidates that a source labels, each with as much text around it as ``describe`` reads."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        pieces, spans = [], []
        for t in batch.column("text").to_pylist():
            for a, b, sure in marked_candidates(t or ""):
                if (label := source_label(t, a, b, sure)) is not None:
                    first = max(0, a - BEFORE)
                    pieces.append(t[first : b + AFTER])
                    spans.append([{"start": a - first, "end": b - first, "label": label}])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.int32())]))
        yield pa.RecordBatch.from_arrays([pa.array(pieces, pa.string()), pa.array(spans, kind)], ["text", "spans"])

    texts = docs.filter("doc_id is not null").select("text")
    return arrow_map(texts, run, "text string, spans array<struct<start:long,end:long,label:int>>")


def given_findings(docs: DataFrame, findings: DataFrame) -> DataFrame:
    """(text, spans): the texts with labelled findings (doc_id, start, end, label)."""
    known = findings.filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
    spans = F.sort_array(F.collect_set(F.struct("start", "end", "label"))).alias("spans")
    return docs.select("doc_id", "text").join(known.groupBy("doc_id").agg(spans), "doc_id").select("text", "spans")


def fit(docs: DataFrame, findings: DataFrame | None = None, per_class: int = PER_CLASS, seed: int = 11) -> Forest:
    """A forest from all labelled findings (doc_id, start, end, label)."""
    weak = findings is None
    words = dictionary(docs)
    marked = weak_findings(docs) if weak else given_findings(docs, findings)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        x, y = [], []
        for text, listed in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            for s in listed:
                if text and s["end"] <= len(text) and s["end"] > s["start"]:
                    values = describe(text, s["start"], s["end"], words)
                    x.append([0.0 if weak and i in CUES else v for i, v in enumerate(values)])
                    y.append(s["label"])
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), pa.array(y, pa.int32())], ["x", "y"])

    described = written(arrow_map(marked, run, "x array<double>, y int"), "findings")
    sizes = {r["y"]: r["count"] for r in described.groupBy("y").count().collect()}
    if len(sizes) < 2:
        return Forest(words, [], weak)
    if max(sizes.values()) > per_class:
        return Forest(words, spark_forest(described, sizes, per_class, seed), weak)
    rows = sorted((r["y"], r["x"]) for r in described.collect())
    x, y = np.array([r[1] for r in rows]), np.array([r[0] for r in rows], dtype=float)
    rng = np.random.default_rng(seed)
    return Forest(words, [grow(x, y, rng) for _ in range(TREES)], weak)


def found(text: str | None, forest: Forest) -> list[tuple[int, int, float]]:
    """(start, end, score) of all candidates of a text."""
    spans = candidates(text)
    if not spans:
        return []
    return [(a, b, round(float(s), 6)) for (a, b), s in zip(spans, forest.scores(text, spans), strict=True)]


def scan(docs: DataFrame, forest: Forest, cut: float = CUT) -> DataFrame:
    """One row per document: candidate and secret counts, and the secrets as start:end:score."""
    shared = docs.sparkSession.sparkContext.broadcast(forest)
    names = ["doc_id", "n_candidates", "n_secrets", "secrets"]

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        listed = [found(t, shared.value) for t in batch.column("text").to_pylist()]
        kept = [[f for f in fs if f[2] >= cut] for fs in listed]
        spans = [",".join(f"{a}:{b}:{s:.6f}" for a, b, s in fs) for fs in kept]
        arrays = [pa.array([len(fs) for fs in x], pa.int64()) for x in (listed, kept)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays, pa.array(spans, pa.string())], names)

    return arrow_map(docs.select("doc_id", "text"), run, "doc_id long, n_candidates long, n_secrets long, secrets string")


def mask(text: str | None, forest: Forest, cut: float = CUT) -> str | None:
    """The text with every secret replaced."""
    for a, b, s in reversed(found(text, forest)):
        if s >= cut:
            text = text[:a] + MASK + text[b:]
    return text


def redact(docs: DataFrame, forest: Forest, cut: float = CUT) -> DataFrame:
    """The documents with secrets masked; all other columns stay as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(forest)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        masked = pa.array([mask(t, shared.value, cut) for t in batch.column("text").to_pylist()], pa.string())
        yield batch.set_column(batch.schema.get_field_index("text"), "text", masked)

    return arrow_map(docs, run, docs.schema)
