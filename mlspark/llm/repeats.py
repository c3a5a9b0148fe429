"""Periodic runs of words, found on a Re-Pair grammar (operator 11).

A run is a stretch of words with smallest period q, at least ``SHORTEST`` words and ``TIMES`` periods long,
that no neighbouring word extends.  The texts of a batch become one sequence of word ids in which pairs
never reach over a text's end.  Re-Pair replaces the pairs that occur twice or more by nonterminals; what
is left of each text is paired up to a balanced tree.  For every nonterminal the runs that cross the
boundary between its two halves are computed once, at one place of the text.  They are then translated to
all places of its derivation, and stretches of equal period that lie within each other are merged.

* Pairs are replaced in rounds.  A round takes every pair that no overlapping pair beats by count (ties: by
  a hash), so the most frequent pair always goes first and equal pairs are replaced alike everywhere.
* A run with period q repeats a stretch of ``SHORTEST * (TIMES - 1) / TIMES`` words q words further on, and
  such stretches cover it.  Words outside every repeated stretch of their text cannot be in a run; the
  grammar is built over the others.  This drops no run.
* Stretches that repeat are compared by two polynomial hashes modulo primes of 31 bits.

Work is done text by text inside the tasks that read them: nothing is shuffled, and a batch holds at most
``common.SLICE_BYTES`` of text or a single longer text.

Defined cases: a missing text or one without words has no runs and an empty collapsed text; equal rows give
equal results, each its own; a missing doc_id is kept; an empty table gives no rows; other columns, also ones
called ``runs`` or ``collapsed``, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mlspark.llm.common import Words, arrow_map, mix

SHORTEST = 24
TIMES = 3
PRIMES = (2147483647, 2147483629)
BASES = (1103515245, 747796405)
ODD = 0x9E3779B97F4A7C15  # base of the window hashes modulo 2**64
CHUNK = 1 << 21  # (nonterminal, period) candidates looked at together
SCHEMA = "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def windows(codes: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every window of ``width`` codes; equal windows have equal hashes."""
    n = len(codes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        up = np.cumprod(np.full(len(codes), ODD, dtype=np.uint64))
        down = np.cumprod(np.full(n, pow(ODD, -1, 1 << 64), dtype=np.uint64))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(codes.astype(np.uint64) + np.uint64(1)) * up)])
        return (sums[width:] - sums[:-width]) * down


def covered(codes: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """Words in a window that their text holds twice or more."""
    n = len(codes)
    keys = windows(codes, width)
    if not len(keys):
        return np.zeros(n, dtype=bool)
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    inside = np.arange(len(keys)) + width <= starts[owner[: len(keys)] + 1]
    at = np.flatnonzero(inside)
    keys = mix(keys[at] + mix(owner[at].astype(np.uint64) + np.uint64(7)))
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(n, dtype=bool)
    place = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    hits = at[twice[place] == keys]
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, hits, 1)
    np.add.at(change, hits + width, -1)
    return np.cumsum(change[:-1]) > 0


class Grammar:
    """Nonterminals over a sequence whose segments are kept apart.

    Symbol k < ``terminals`` is a word; the others have two halves ``left`` and ``right``, a ``size`` in words
    and a place ``at`` where they occur.  ``rounds`` holds the bounds of what each round added; ``roots`` are
    one symbol for each segment with its place.
    """

    def __init__(self, codes: np.ndarray, segment: np.ndarray) -> None:
        words, symbols = np.unique(codes, return_inverse=True)
        self.terminals = len(words)
        self.size = np.ones(self.terminals, dtype=np.int64)
        self.left = np.full(self.terminals, -1, dtype=np.int64)
        self.right = self.left.copy()
        self.at = np.zeros(self.terminals, dtype=np.int64)
        self.rounds = [self.terminals]
        self._symbols, self._segment, self._at = symbols.astype(np.int64), segment, np.arange(len(codes), dtype=np.int64)
        while (chosen := self._frequent()) is not None:
            self._replace(*chosen)
        while len(self._symbols) and (pairs := self._neighbours()) is not None:
            self._replace(*pairs)
        self.roots, self.root_at = self._symbols, self._at

    def _within(self) -> np.ndarray:
        return self._segment[1:] == self._segment[:-1]

    def _frequent(self) -> tuple[np.ndarray, np.ndarray] | None:
        """Places of this round's pairs and, for each, the number of its pair."""
        s, m = self._symbols, len(self.size)
        if len(s) < 2:
            return None
        within, same = self._within(), s[1:] == s[:-1]
        index = np.arange(len(s) - 1)
        # in a stretch of one symbol every second place is an occurrence of the pair
        opens = np.ones(len(s) - 1, dtype=bool)
        opens[1:] = ~(same[:-1] & within[:-1])
        odd = (index - np.maximum.accumulate(np.where(opens, index, 0))) & 1
        places = np.flatnonzero(within & ~(same & (odd == 1)))
        keys, number, counts = np.unique(s[places] * m + s[places + 1], return_inverse=True, return_counts=True)
        often = np.flatnonzero(counts > 1)
        if not len(often):
            return None
        a, b = keys[often] // m, keys[often] % m
        rank = np.empty(len(often), dtype=np.int64)
        rank[np.lexsort((keys[often], mix(keys[often].astype(np.uint64)), -counts[often]))] = np.arange(len(often))
        first, second = np.full(m, len(often)), np.full(m, len(often))
        np.minimum.at(first, a, rank)  # the best pair that begins with a symbol
        np.minimum.at(second, b, rank)  # the best pair that ends with it
        wins = (rank <= first[b]) & (rank <= second[a])
        chosen = np.full(len(keys), -1, dtype=np.int64)
        chosen[often[wins]] = np.arange(int(wins.sum()))
        kind = chosen[number]
        return places[kind >= 0], kind[kind >= 0]

    def _neighbours(self) -> tuple[np.ndarray, np.ndarray] | None:
        """Every second place of each segment that still has two symbols."""
        within, index = self._within(), np.arange(len(self._symbols))
        opens = np.concatenate([[True], ~within])
        even = (index - np.maximum.accumulate(np.where(opens, index, 0))) & 1 == 0
        places = np.flatnonzero(within & even[:-1])
        return (places, np.arange(len(places))) if len(places) else None

    def _replace(self, places: np.ndarray, kind: np.ndarray) -> None:
        m, new = len(self.size), int(kind.max()) + 1
        sample = np.zeros(new, dtype=np.int64)
        sample[kind] = places
        left, right = self._symbols[sample], self._symbols[sample + 1]
        self.left, self.right = np.concatenate([self.left, left]), np.concatenate([self.right, right])
        self.at = np.concatenate([self.at, self._at[sample]])
        self.size = np.concatenate([self.size, self.size[left] + self.size[right]])
        self.rounds.append(m + new)
        self._symbols[places] = m + kind
        keep = np.ones(len(self._symbols), dtype=bool)
        keep[places + 1] = False
        self._symbols, self._segment, self._at = self._symbols[keep], self._segment[keep], self._at[keep]


class Compare:
    """How far two places of a sequence agree, by prefix sums of polynomial hashes."""

    def __init__(self, codes: np.ndarray) -> None:
        self.sums, self.powers = [], []
        values = mix(codes.astype(np.uint64) + np.uint64(3))
        for prime, base in zip(PRIMES, BASES, strict=True):
            p = np.ones(1, dtype=np.uint64)
            while len(p) <= len(codes):
                p = np.concatenate([p, p * np.uint64(pow(base, len(p), prime)) % np.uint64(prime)])
            terms = values % np.uint64(prime) * p[: len(codes)] % np.uint64(prime)
            self.sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)]))
            self.powers.append(p)

    def equal(self, i: np.ndarray, j: np.ndarray, width: int) -> np.ndarray:
        """Whether ``width`` codes from i and from j > i are the same."""
        good = np.ones(len(i), dtype=bool)
        for prime, sums, powers in zip(PRIMES, self.sums, self.powers, strict=True):
            p = np.uint64(prime)
            good &= (sums[i + width] - sums[i]) % p * powers[j - i] % p == (sums[j + width] - sums[j]) % p
        return good

    def extent(self, i: np.ndarray, j: np.ndarray, limit: np.ndarray, step: int) -> np.ndarray:
        """Codes that agree from i and j on (step 1), or up to and without them (step -1), at most ``limit``."""
        reach = np.zeros(len(i), dtype=np.int64)
        width = 1 << max(int(limit.max(initial=0)).bit_length() - 1, 0)
        while width:
            fits = np.flatnonzero(reach + width <= limit)
            shift = reach[fits] if step > 0 else -reach[fits] - width
            same = self.equal(i[fits] + shift, j[fits] + shift, width)
            reach[fits[same]] += width
            width >>= 1
        return reach


def crossing(g: Grammar, codes: np.ndarray, shortest: int, times: int) -> tuple[np.ndarray, ...]:
    """Runs over the boundary of each nonterminal, within it: nonterminal, start, end (relative), period."""
    found: list[np.ndarray] = []
    big = np.flatnonzero(g.size >= max(shortest, 2))
    big = big[big >= g.terminals]
    if not len(big):
        return tuple(np.empty((4, 0), dtype=np.int64))
    compare = Compare(codes)
    # the stretch that agrees holds at least 2 * half - 1 words around a place next to the boundary
    half = max((shortest * (times - 1) // times + 1) // 2, 1)
    near = windows(codes, half)

    def alike(i: np.ndarray, q: np.ndarray) -> np.ndarray:
        i, j = np.clip(i, 0, len(near) - 1), np.clip(i + q, 0, len(near) - 1)
        return near[i] == near[j]

    periods = g.size[big] // times
    ends = np.cumsum(periods)
    for low in range(0, int(ends[-1]), CHUNK):
        flat = np.arange(low, min(low + CHUNK, int(ends[-1])))
        k = np.searchsorted(ends, flat, side="right")
        x, q = big[k], flat - (ends[k] - periods[k]) + 1
        lo = g.at[x]
        b, hi = lo + g.size[g.left[x]], lo + g.size[x]
        for right in (True, False):
            anchor = b if right else b - 1 - q
            fits = (b + q < hi) if right else (anchor >= lo)
            keep = np.flatnonzero(fits)
            keep = keep[codes[anchor[keep]] == codes[anchor[keep] + q[keep]]]
            keep = keep[alike(anchor[keep], q[keep]) | alike(anchor[keep] - half + 1, q[keep])]
            if not len(keep):
                continue
            kx, kq, klo, kb, khi = x[keep], q[keep], lo[keep], b[keep], hi[keep]
            i = kb if right else kb - kq
            ahead = compare.extent(i, i + kq, khi - i - kq, 1)
            back = compare.extent(i, i + kq, i - klo, -1)
            start, end = i - back, i + kq + ahead
            good = (start < kb) & (end > kb) & (end - start >= np.maximum(shortest, times * kq))
            found.append(np.stack([kx, start - klo, end - klo, kq])[:, good])
    if not found:
        return tuple(np.empty((4, 0), dtype=np.int64))
    rows = np.concatenate(found, axis=1)
    rows = rows[:, np.lexsort((rows[3], rows[2], rows[1], rows[0]))]
    fresh = np.ones(rows.shape[1], dtype=bool)  # equal stretches: the smallest period
    fresh[1:] = (rows[:3, 1:] != rows[:3, :-1]).any(axis=0)
    return tuple(rows[:, fresh])


def derived(g: Grammar, x: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> np.ndarray:
    """The runs of all nonterminals at all places of the derivation: rows start, end, period."""
    first = np.searchsorted(x, np.arange(len(g.size) + 1))
    own = np.diff(first)
    holds = own > 0
    for a, b in zip(g.rounds[:-1], g.rounds[1:], strict=True):
        holds[a:b] |= holds[g.left[a:b]] | holds[g.right[a:b]]
    symbols, at = g.roots, g.root_at
    out = [np.empty((3, 0), dtype=np.int64)]
    while True:
        keep = holds[symbols]
        symbols, at = symbols[keep], at[keep]
        if not len(symbols):
            return np.concatenate(out, axis=1)
        n = own[symbols]
        pick = np.repeat(first[symbols] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        shift = np.repeat(at, n)
        out.append(np.stack([start[pick] + shift, end[pick] + shift, period[pick]]))
        left, right = g.left[symbols], g.right[symbols]
        symbols, at = np.concatenate([left, right]), np.concatenate([at, at + g.size[left]])


def merged(rows: np.ndarray) -> np.ndarray:
    """Stretches that lie within another of their period go; of equal ones the smallest period stays."""
    start, end, period = rows[:, np.lexsort((-rows[1], rows[0], rows[2]))]
    if not len(start):
        return rows
    _, group = np.unique(period, return_inverse=True)
    reach = end + group * (int(end.max()) + 1)
    before = np.concatenate([[-1], np.maximum.accumulate(reach)[:-1]])
    rows = np.stack([start, end, period])[:, reach > before]
    rows = rows[:, np.lexsort((rows[2], rows[1], rows[0]))]
    fresh = np.ones(rows.shape[1], dtype=bool)
    fresh[1:] = (rows[:2, 1:] != rows[:2, :-1]).any(axis=0)
    return rows[:, fresh]


def find_runs(codes: np.ndarray, starts: np.ndarray, shortest: int = SHORTEST, times: int = TIMES) -> np.ndarray:
    """All runs of texts whose words ``codes`` lie one after the other, text t from ``starts[t]``.

    Rows start, end, period, as positions in ``codes``, in the order of start and period.
    """
    if times < 3 or shortest < times:
        # one side of a boundary must hold more than a period
        raise ValueError("a run has at least three periods")
    mask = covered(codes, starts, max(shortest * (times - 1) // times, 1))
    source = np.flatnonzero(mask)
    if not len(source):
        return np.empty((3, 0), dtype=np.int64)
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))[source]
    breaks = (np.diff(source) > 1) | (np.diff(owner) > 0)
    segment = np.concatenate([[0], np.cumsum(breaks)])
    inner = codes[source]
    g = Grammar(inner, segment)
    rows = merged(derived(g, *crossing(g, inner, shortest, times)))
    rows = np.stack([source[rows[0]], source[rows[1] - 1] + 1, rows[2]])
    return rows[:, np.lexsort((rows[2], rows[0]))]


def find(docs: DataFrame, shortest: int = SHORTEST, times: int = TIMES) -> DataFrame:
    """(doc_id, runs, collapsed) of every row: runs by start and period in word numbers, and the text's words,
    one blank apart, without those that a run holds after its first period."""

    def search(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words = Words(batch.column("text"))
        rows = find_runs(words.codes, words.starts, shortest, times)
        texts = np.searchsorted(words.starts, rows[0], side="right") - 1
        change = np.zeros(len(words.codes) + 1, dtype=np.int64)
        np.add.at(change, rows[0] + rows[2], 1)
        np.add.at(change, rows[1], -1)
        kept = np.cumsum(change[:-1]) == 0
        bounds = np.concatenate([[0], np.cumsum(kept)])[words.starts]
        flat = pc.take(words.dictionary, pa.array(words.codes[kept]))
        collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), flat), pa.scalar(" ", pa.large_string()))
        fields = [rows[0] - words.starts[texts], rows[1] - rows[0], rows[2]]
        items = pa.StructArray.from_arrays([pa.array(f, pa.int64()) for f in fields], ["start", "length", "period"])
        offsets = np.searchsorted(texts, np.arange(batch.num_rows + 1))
        runs = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), items)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), runs, collapsed.cast(pa.string())], ["doc_id", "runs", "collapsed"])

    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), search, SCHEMA)


def plant(docs: DataFrame) -> DataFrame:
    """The texts of the query: in every tenth one the words from some place on repeat what stands there."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+", -1), lambda w: w != "")

    def repeated(w: Column) -> Column:
        n, g = F.size(w), F.floor(h / 10).cast("long")
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8)))).cast("long")

        def place(bounds: Column) -> Column:
            def word(x: Column, i: Column) -> Column:
                return F.when(i < bounds["a"], x).otherwise(F.get(w, (bounds["a"] + (i - bounds["a"]) % bounds["p"]).cast("int")))

            return F.array_join(F.transform(w, word), " ")

        pair = F.struct(a.alias("a"), p.alias("p"))
        return F.when(n > 0, F.get(F.transform(F.array(pair), place), 0)).otherwise("")

    planted = F.get(F.transform(F.array(words), repeated), 0)
    return docs.select("doc_id", F.when(h % 10 == 0, planted).otherwise(F.col("text")).alias("text"))


def report(found: DataFrame) -> DataFrame:
    """Digests of the runs and the collapsed text, and the run with the greatest length by period."""

    def better(best: Column, run: Column) -> Column:
        # runs come by start and period, so the earlier one wins a tie
        return F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best)

    best = F.reduce("runs", F.lit(None).cast("struct<start:long,length:long,period:long>"), better)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = found.withColumn("best", best)
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
