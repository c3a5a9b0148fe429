"""SentencePiece encoding and decoding: N-best segmentation over the piece lattice (operator 6).

Spaces become the mark U+2581 and one mark is put before the text.  No piece crosses a boundary between
two characters that stand next to each other in no piece, so a text is cut there into segments, and
forward and backward Viterbi scores of all distinct segments are computed together, in arrays.  They give
each segment's best path and what its second path costs more.  A text's N best segmentations are sums
over segments, and only the N - 1 cheapest changes of one segment can take part; the segments that can
hold these are searched from the end by A-star, where the forward scores are the exact heuristic, so
paths leave the queue in order of their score.

A character without a piece costs ``UNKNOWN`` below the worst piece and becomes its UTF-8 byte pieces.
Equal scores go to the smaller ids read from the end; inside one segment of more than ``LONG``
characters they go by search order, which is fixed too.

Defined cases: a missing or empty text has one empty segmentation with score 0; a text with fewer than N
segmentations has fewer rows; U+2581 in a text reads as a space, as in the format; equal texts give
equal rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from mlspark.llm.common import arrow_map

MARK = "▁"
BEST = 4
UNKNOWN = 10.0
LONG = 512
CACHED = 100_000
TABLE = 1 << 22
WIDE = 64  # longer segments are searched one by one
CELLS = 1 << 16  # characters of the segments that are solved together
HASH = 0x5851F42D4C957F2D

Path = tuple[float, tuple[int, ...]]


class Pieces:
    """The normal pieces of a model file, and which neighbouring characters occur inside a piece."""

    def __init__(self, model_file: str) -> None:
        import public_tokenizers
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(model_file))
        size = model.get_piece_size()
        special = [model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(size)]
        self.ids = {model.id_to_piece(i): (i, model.get_score(i)) for i in range(size) if not special[i]}
        self.reach: dict[str, int] = {}
        for piece in self.ids:
            self.reach[piece[:2]] = max(len(piece), self.reach.get(piece[:2], 0))
        self.bytes = {int(model.id_to_piece(i)[3:5], 16): i for i in range(size) if model.is_byte(i)}
        self.worst = min(score for _, score in self.ids.values()) - UNKNOWN
        # a full table would only cut less, never wrongly
        self.inside = np.zeros(TABLE, bool)
        for piece in self.ids:
            self.inside[pair_slots(points(piece))] = True
        surface = [b"" if special[i] else model.id_to_piece(i).replace(MARK, " ").encode() for i in range(size)]
        for value, i in self.bytes.items():
            surface[i] = bytes([value])
        self.surface_size = np.array([len(s) for s in surface], dtype=np.int64)
        self.surface_start = np.cumsum(self.surface_size) - self.surface_size
        self.surface = np.frombuffer(b"".join(surface), dtype=np.uint8)
        self.cache: dict[str, list[Path]] = {}
        # pieces by the hash of their characters, for lookups in arrays
        named = {}
        for piece, (i, score) in self.ids.items():
            h = 0
            for c in piece:
                h = (h * HASH + ord(c) + 1) % (1 << 64)
            named[h] = (i, score)
        if len(named) != len(self.ids):
            raise ValueError("two pieces share a hash")
        self.hashes = np.array(sorted(named), dtype=np.uint64)
        self.hashed_id = np.array([named[int(h)][0] for h in self.hashes], dtype=np.int64)
        self.hashed_score = np.array([named[int(h)][1] for h in self.hashes])
        self.maybe = np.zeros(TABLE, bool)
        self.maybe[slots(self.hashes)] = True
        self.longest = max(map(len, self.ids))

    def lattice(self, s: str) -> tuple[list[list[tuple[int, float, tuple[int, ...]]]], list[float]]:
        """For every place, the pieces that end there (start, score, ids) and the best score up to it."""
        size = len(s)
        ends: list = [[] for _ in range(size + 1)]
        best = [0.0] + [-np.inf] * size
        get, reach = self.ids.get, self.reach.get
        for i in range(size):
            here = best[i]
            single = get(s[i])
            if single is None:
                edge = (i, self.worst, tuple(self.bytes[b] for b in s[i].encode()))
            else:
                edge = (i, single[1], (single[0],))
            ends[i + 1].append(edge)
            if here + edge[1] > best[i + 1]:
                best[i + 1] = here + edge[1]
            # no piece that begins with these two characters is longer than their reach
            for j in range(i + 2, min(size, i + reach(s[i : i + 2], 0)) + 1):
                piece = get(s[i:j])
                if piece is not None:
                    score = piece[1]
                    ends[j].append((i, score, (piece[0],)))
                    if here + score > best[j]:
                        best[j] = here + score
        return ends, best

    def search(self, s: str, n: int) -> list[Path]:
        """The n best (score, ids) of one segment."""
        ends, best = self.lattice(s)
        return search_long(ends, best, n) if len(s) > LONG else search_short(ends, best, n)

    def segment_paths(self, s: str, n: int) -> list[Path]:
        key = s
        found = self.cache.get(key)
        if found is None or len(found) < n and found[-1][0] != -np.inf:
            found = self.search(s, n)
            if len(found) < n:
                found.append((-np.inf, ()))  # there are no more
            if len(self.cache) >= CACHED:
                self.cache.clear()
            if len(s) <= LONG:
                self.cache[key] = found
        return [p for p in found[:n] if p[0] != -np.inf]

    def segments(self, text: str) -> list[str]:
        """The marked text, cut where no piece can cross."""
        if not text:
            return []
        marked = MARK + text.replace(" ", MARK)
        cuts = np.flatnonzero(~self.inside[pair_slots(points(marked))]) + 1
        bounds = [0, *cuts.tolist(), len(marked)]
        return [marked[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """The text of a segmentation as UTF-8, without the space that encoding put before it."""
        sizes = self.surface_size[ids]
        at = np.repeat(self.surface_start[ids] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        out = self.surface[at].tobytes()
        return out[1:] if out[:1] == b" " else out

    def decode(self, ids: list[int]) -> str:
        return self.decode_bytes(np.array(ids, dtype=np.int64)).decode("utf-8", "replace")

    def n_best(self, text: str, n: int) -> list[tuple[float, np.ndarray]]:
        """The n best segmentations of a text: score and ids, best first."""
        return list(self.n_best_many([text], n))[0]

    def solve(self, segments: list[str], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Score, ids (flat, with sizes) of the best path of each segment, and the cost of its second path."""
        count = len(segments)
        score, gap = np.zeros(count), np.full(count, np.inf)
        ids: list = [None] * count
        length = np.array([len(s) for s in segments], dtype=np.int64)
        for k in np.flatnonzero(length > WIDE).tolist():
            found = self.segment_paths(segments[k], max(n, 2))
            score[k], ids[k] = found[0]
            if len(found) > 1:
                gap[k] = found[0][0] - found[1][0]
        order = np.argsort(length, kind="stable")
        order = order[length[order] <= WIDE]
        at = 0
        while at < len(order):
            # as many segments of about one length as fill the arrays
            take = max(1, CELLS // int(length[order[min(at + CELLS // 64, len(order) - 1)]]))
            rows = order[at : at + take]
            at += take
            self.solve_group([segments[k] for k in rows], rows, score, gap, ids)
        sizes = np.array([len(i) for i in ids], dtype=np.int64)
        flat = np.concatenate([np.asarray(i, dtype=np.int64) for i in ids]) if count else np.empty(0, np.int64)
        return score, flat, sizes, gap

    def solve_group(self, group: list[str], rows: np.ndarray, score: np.ndarray, gap: np.ndarray, ids: list) -> None:
        n, width = len(group), max(map(len, group))
        length = np.array([len(s) for s in group])
        text = np.zeros((n, width), np.uint64)
        text[np.arange(width) < length[:, None]] = points("".join(group)).astype(np.uint64) + np.uint64(1)
        most = min(width, self.longest)
        # edge[k] starts at each place and spans k + 1 characters
        edge_score = [np.full((n, width - k), -np.inf) for k in range(most)]
        edge_id = [np.full((n, width - k), -1, np.int64) for k in range(most)]
        hashed = np.zeros((n, width), np.uint64)
        for k in range(most):
            hashed = hashed[:, : width - k] * np.uint64(HASH) + text[:, k:]
            inside = np.arange(width - k) + k < length[:, None]
            r, c = np.nonzero(self.maybe[slots(hashed)] & inside)
            h = hashed[r, c]
            place = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            hit = self.hashes[place] == h
            edge_score[k][r[hit], c[hit]] = self.hashed_score[place[hit]]
            edge_id[k][r[hit], c[hit]] = self.hashed_id[place[hit]]
        unknown = (edge_id[0] < 0) & (np.arange(width) < length[:, None])
        edge_score[0][unknown] = self.worst
        forward = np.full((n, width + 1), -np.inf)
        forward[:, 0] = 0
        for j in range(1, width + 1):
            for k in range(min(j, most)):
                np.maximum(forward[:, j], forward[:, j - k - 1] + edge_score[k][:, j - k - 1], out=forward[:, j])
        backward = np.full((n, width + 1), -np.inf)
        backward[np.arange(n), length] = 0
        for i in range(width - 1, -1, -1):
            for k in range(min(width - i, most)):
                np.maximum(backward[:, i], edge_score[k][:, i] + backward[:, i + k + 1], out=backward[:, i])
        total = forward[np.arange(n), length]
        through = [forward[:, : width - k] + edge_score[k] + backward[:, k + 1 :] for k in range(most)]
        # the best path from the end, by the smallest id among the best edges; its edges are then left out
        live, place = np.arange(n), length.copy()
        steps = []
        while len(live):
            end = place[live]
            best_key, best_k = np.full(len(live), np.iinfo(np.int64).max), np.zeros(len(live), np.int64)
            for k in range(min(most, int(end.max()))):
                start = np.maximum(end - k - 1, 0)
                ok = (end > k) & (forward[live, start] + edge_score[k][live, np.minimum(start, width - k - 1)] == forward[live, end])
                key = edge_id[k][live, np.minimum(start, width - k - 1)]
                ok &= key < best_key
                best_key, best_k = np.where(ok, key, best_key), np.where(ok, k, best_k)
            start = end - best_k - 1
            steps.append((live, start, best_key))
            for k in np.unique(best_k):
                mine = best_k == k
                through[k][live[mine], start[mine]] = -np.inf
            place[live] = start
            live = live[start > 0]
        second = np.max([t.max(axis=1) for t in through], axis=0)
        score[rows], gap[rows] = total, total - second
        row, start, piece = (np.concatenate(x) for x in zip(*steps, strict=True))
        order = np.lexsort((start, row))
        row, start, piece = row[order], start[order], piece[order]
        bounds = np.searchsorted(row, np.arange(n + 1))
        odd = set(row[piece < 0].tolist())
        for k, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
            if k in odd:
                path = zip(start[a:b].tolist(), piece[a:b].tolist(), strict=True)
                ids[rows[k]] = [i for at, p in path for i in ([p] if p >= 0 else [self.bytes[x] for x in group[k][at].encode()])]
            else:
                ids[rows[k]] = piece[a:b]

    def n_best_many(self, texts: list[str], n: int) -> Iterator[list[tuple[float, np.ndarray]]]:
        index: dict[str, int] = {}
        listed = [np.array([index.setdefault(s, len(index)) for s in self.segments(t)], dtype=np.int64) for t in texts]
        names = list(index)
        score, flat, size, gap = self.solve(names, n)
        start = np.cumsum(size) - size
        for codes in listed:
            sizes = size[codes]
            ends = np.cumsum(sizes)
            best = flat[np.repeat(start[codes] - (ends - sizes), sizes) + np.arange(int(sizes.sum()))]
            total = float(score[codes].sum())
            out = []
            for extra, chosen in self.best_changes(codes, gap, names, n):
                ids = best
                for place, path in sorted(chosen, reverse=True, key=lambda c: c[0]):
                    a, b = int(ends[place] - sizes[place]), int(ends[place])
                    ids = np.concatenate([ids[:a], np.array(path, dtype=np.int64), ids[b:]])
                out.append((total - extra, ids))
            yield out

    def best_changes(self, codes: np.ndarray, gap: np.ndarray, names: list[str], n: int) -> list[tuple[float, list]]:
        """The n best choices as (cost, [(segment, ids)]), beginning with no change."""
        costs = gap[codes]
        finite = int(np.isfinite(costs).sum())
        wanted = min(n - 1, finite)
        if wanted <= 0:
            return [(0.0, [])]
        # n - 1 segments change at this cost or less, so no dearer change takes part
        limit = np.partition(costs, wanted - 1)[wanted - 1] if finite >= n - 1 else np.inf
        places = np.flatnonzero((costs <= limit) & np.isfinite(costs))
        paths = {int(c): self.segment_paths(names[c], n) for c in np.unique(codes[places])}
        cost = np.full((len(places), n - 1), np.inf)
        sooner = np.zeros(cost.shape, bool)
        for row, place in enumerate(places.tolist()):
            found = paths[int(codes[place])]
            for r, (value, ids) in enumerate(found[1:]):
                cost[row, r] = found[0][0] - value
                sooner[row, r] = ids[::-1] < found[0][1][::-1]
        changes = [(int(places[row]), r, c) for row, r, c in cheapest(cost, sooner, n - 1)]
        ranked = []
        for take in range(len(changes) + 1):
            for chosen in combinations(changes, take):
                if len({place for place, _, _ in chosen}) == take:
                    ranked.append((sum(c for _, _, c in chosen), chosen))
        ranked.sort(key=lambda item: item[0])
        kept = in_tie_order(ranked, codes, paths)[:n]
        return [(extra, [(place, paths[int(codes[place])][r + 1][1]) for place, r, _ in chosen]) for extra, chosen in kept]


def points(s: str) -> np.ndarray:
    return np.frombuffer(s.encode("utf-32-le"), dtype=np.uint32)


def pair_slots(code: np.ndarray) -> np.ndarray:
    """A slot for each pair of neighbouring characters."""
    mixed = code[:-1].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + code[1:].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    return (mixed >> np.uint64(42)).astype(np.int64)


def slots(hashes: np.ndarray) -> np.ndarray:
    mixed = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(42)).astype(np.int64)


def search_short(ends: list, best: list[float], n: int) -> list[Path]:
    """A-star from the end; among equal scores the queue gives the smaller ids read from the end."""
    queue: list = [(-best[-1], (), len(best) - 1, 0.0)]
    out: list[Path] = []
    popped = [0] * len(best)
    while queue and len(out) < n:
        value, back, place, done = heappop(queue)
        if not place:
            out.append((-value, back[::-1]))
            continue
        # the n best texts pass a place in its n first visits at most
        popped[place] += 1
        if popped[place] <= n:
            for i, score, ids in ends[place]:
                heappush(queue, (-(done + score + best[i]), back + ids[::-1], i, done + score))
    return out


def search_long(ends: list, best: list[float], n: int) -> list[Path]:
    """The same with linked paths, for segments whose paths are too long to copy."""
    queue: list = [(-best[-1], 0, len(best) - 1, 0.0, None)]
    out: list[Path] = []
    pushed, popped = 0, [0] * len(best)
    while queue and len(out) < n:
        value, _, place, done, link = heappop(queue)
        popped[place] += 1
        if popped[place] > n:
            continue
        if not place:
            ids: list[int] = []
            while link is not None:
                ids.extend(link[0])
                link = link[1]
            out.append((-value, tuple(ids)))
            continue
        for i, score, ids_here in ends[place]:
            pushed += 1
            heappush(queue, (-(done + score + best[i]), pushed, i, done + score, (ids_here, link)))
    return out


def cheapest(cost: np.ndarray, sooner: np.ndarray, n: int) -> list[tuple[int, int, float]]:
    """The n first changes of one segment as (segment, path, cost), in the order of the texts they give."""
    values = cost.ravel()
    finite = int(np.isfinite(values).sum())
    n = min(n, finite)
    if n <= 0:
        return []
    limit = np.partition(values, n - 1)[n - 1]
    at = np.flatnonzero(values <= limit)
    place, path = at // cost.shape[1], at % cost.shape[1]
    early = sooner.ravel()[at]
    # smaller ids: the later segment first; larger ids: the earlier segment first
    order = np.lexsort((path, np.where(early, -place, place), ~early, values[at]))[:n]
    return [(int(place[k]), int(path[k]), float(values[at[k]])) for k in order]


def in_tie_order(ranked: list, codes: np.ndarray, paths: dict[int, list[Path]]) -> list:
    """Choices of equal cost by their ids read from the end."""

    def ids(chosen: tuple, place: int) -> tuple[int, ...]:
        r = next((r + 1 for p, r, _ in chosen if p == place), 0)
        return paths[int(codes[place])][r][1][::-1]

    out: list = []
    for item in ranked:
        at = len(out)
        while at and out[at - 1][0] == item[0]:
            places = sorted({p for p, _, _ in (*item[1], *out[at - 1][1])}, reverse=True)
            mine, other = [ids(item[1], p) for p in places], [ids(out[at - 1][1], p) for p in places]
            if not mine < other:
                break
            at -= 1
        out.insert(at, item)
    return out


@lru_cache(maxsize=2)
def model(model_file: str) -> Pieces:
    return Pieces(model_file)


def encode(docs: DataFrame, n: int = BEST, model_file: str = "piece_bpe_32k.model", with_ids: bool = False) -> DataFrame:
    """(doc_id, rank, score, n_pieces, ids_crc32, round_trip) of the n best segmentations, and the ids if asked for."""
    schema = "doc_id long, rank int, score double, n_pieces long, ids_crc32 long, round_trip boolean"

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        pieces = model(model_file)
        texts = [t or "" for t in batch.column("text").to_pylist()]
        rows, listed = [], []
        for doc_id, text, best in zip(batch.column("doc_id").to_pylist(), texts, pieces.n_best_many(texts, n), strict=True):
            same = text.replace(MARK, " ").encode()
            for rank, (score, ids) in enumerate(best, 1):
                checksum = zlib.crc32(ids.astype("<u4").tobytes())
                rows.append((doc_id, rank, score, len(ids), checksum, pieces.decode_bytes(ids) == same))
                if with_ids:
                    listed.append(ids.astype(np.int32))
        types = [pa.int64(), pa.int32(), pa.float64(), pa.int64(), pa.int64(), pa.bool_()]
        arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
        names = ["doc_id", "rank", "score", "n_pieces", "ids_crc32", "round_trip"]
        if with_ids:
            arrays.append(pa.array(listed, pa.list_(pa.int32())))
            names.append("ids")
        yield pa.RecordBatch.from_arrays(arrays, names)

    return arrow_map(docs.select("doc_id", "text"), run, schema + (", ids array<int>" if with_ids else ""))


def decode(encoded: DataFrame, model_file: str = "piece_bpe_32k.model") -> DataFrame:
    """(doc_id, rank, text) from (doc_id, rank, ids); missing ids give a missing text."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        pieces = model(model_file)
        texts = [None if ids is None else pieces.decode(ids) for ids in batch.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("rank"), pa.array(texts, pa.string())], ["doc_id", "rank", "text"])

    return arrow_map(encoded.select("doc_id", "rank", "ids"), run, "doc_id long, rank int, text string")
