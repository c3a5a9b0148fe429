"""Near-duplicate groups by BagMinHash signatures (operator 1).

A text is the multiset of its five-word shingles (one shingle of all words if it has fewer than five).
Each shingle starts Poisson processes over the weight intervals [0,1), [1,2), [2,4), [4,8) and so on.
A process over an interval that reaches past the shingle's count is split by halves: each point draws
the unit cell it falls into and counts only if the cell lies below the count.  The first point of each
of the ``SLOTS`` signature slots is found in time order, so a text costs about ``SLOTS * log(SLOTS)``
points whatever its weights.  Two slots agree with the probability of the weighted Jaccard similarity.

Signatures are cut into bands; texts that share a band hash meet in a bucket.  Exact copies (equal word
sequences) are one text.  In each bucket all texts are compared with one pivot, the text that shares
most buckets; the multisets' exact weighted Jaccard similarity decides.  Links build components.  Where
a bucket still holds several components, the texts outside the pivot's component are compared with all
others of the bucket, block by block inside tasks of bounded size, so no link between components is
lost; a task returns one pair per union, never all pairs of a group.

Defined cases: texts without words (missing, empty, white space) are copies of each other; a missing id
takes part, and a class without any id has a missing class id; repeated rows get equal classes; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mlspark.llm.common import Words, arrow_map, mix
from mlspark.session import written

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 5
SLOTS = BANDS * ROWS
EPS = 1e-9
BLOCK, BLOCK_BYTES = 512, 16 << 20
COLUMNS = 2048


def shingles(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every shingle, text by text."""
    n = words.counts
    if not len(words.codes):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    word = words.hashes()[words.codes]
    owners = words.owners()
    size = np.minimum(n, SHINGLE)[owners]
    position = np.arange(len(word)) - words.starts[:-1][owners]
    first = position <= (n - np.minimum(n, SHINGLE))[owners]
    value = size.astype(np.uint64)
    padded = np.concatenate([word, np.zeros(SHINGLE, np.uint64)])
    for k in range(SHINGLE):
        value = np.where(k < size, mix(value + padded[k : k + len(word)]), value)
    return value[first], owners[first]


def weights(value: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (hash, text) with their count, in the order of texts."""
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return value[at], owner[at], np.diff(np.append(at, len(value)))


def uniform(x: np.ndarray) -> np.ndarray:
    """A number above 0 and at most 1 from the upper 53 bits of a hash."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53


def signatures(value: np.ndarray, owner: np.ndarray, count: np.ndarray, n_texts: int) -> np.ndarray:
    """(texts, SLOTS) signature; a text without shingles has zeros."""
    total = np.bincount(owner, count, minlength=n_texts)
    out = np.zeros(n_texts * SLOTS, np.uint64)
    filled = np.zeros(n_texts * SLOTS, bool)
    # one row per process: the shingle's intervals up to its count
    levels = 1 + np.ceil(np.log2(count)).astype(np.int64)
    row = np.repeat(np.arange(len(value)), levels)
    level = np.arange(len(row)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level == 0, 0, 1 << np.maximum(level - 1, 0))
    width = np.maximum(low, 1)
    seed = mix(value[row] + mix(level.astype(np.uint64) + np.uint64(1)))
    reach = count[row] - low  # unit cells of the interval below the count
    text = owner[row]
    # time until which every slot of a text almost surely has a point; doubled for texts where one has none
    limit = (np.log(SLOTS) + 3) / np.maximum(total, 1)
    todo = total > 0
    while todo.any():
        live = np.flatnonzero(todo[text])
        time = np.zeros(len(live))
        times, slots, marks = [], [], []
        k = 0
        while len(live):
            k += 1
            draw = mix(seed[live] + np.uint64(k * 0x9E3779B97F4A7C15 % (1 << 64)))
            time = time - np.log(uniform(draw)) / (SLOTS * width[live])
            near = time <= limit[text[live]]
            live, time, draw = live[near], time[near], draw[near]
            place = mix(draw ^ np.uint64(0xA5A5A5A5A5A5A5A5))
            cell = (place >> np.uint64(32)).astype(np.int64) & (width[live] - 1)
            inside = cell < reach[live]
            slot = ((place & np.uint64(0xFFFFFFFF)) % np.uint64(SLOTS)).astype(np.int64)
            times.append(time[inside])
            slots.append((text[live] * SLOTS + slot)[inside])
            marks.append(draw[inside])
        when, where, mark = np.concatenate(times), np.concatenate(slots), np.concatenate(marks)
        order = np.argsort(-when, kind="stable")
        out[where[order]] = mark[order]  # the earliest point is written last
        filled[where] = True
        todo &= ~filled.reshape(n_texts, SLOTS).all(axis=1)
        limit = limit * 2
    return out.reshape(n_texts, SLOTS)


def band_hashes(signature: np.ndarray) -> np.ndarray:
    parts = signature.reshape(len(signature), BANDS, ROWS)
    value = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for k in range(ROWS):
        value = mix(value + parts[:, :, k])
    return value.view(np.int64)


def content_key(text: str | None) -> bytes:
    """A 128-bit name of the text's word sequence."""
    return blake2b(b" ".join((text or "").encode().split()), digest_size=16).digest()


def signed(docs: DataFrame) -> DataFrame:
    """(doc_id, key, bands, size) of every row; size is the text's length in bytes."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = batch.column("text")
        words = Words(texts)
        value, owner, count = weights(*shingles(words))
        bands = band_hashes(signatures(value, owner, count, batch.num_rows))
        keys = pa.array([content_key(t) for t in texts.to_pylist()], pa.binary())
        offsets = np.concatenate([[0], np.cumsum(np.where(words.counts > 0, BANDS, 0))]).astype(np.int32)
        listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(bands[words.counts > 0].ravel()))
        size = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), keys, listed, size], ["doc_id", "key", "bands", "size"])

    return arrow_map(docs.select("doc_id", "text"), run, "doc_id long, key binary, bands array<long>, size long")


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets given as sorted distinct values and counts."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    return both / max(1, int(a[1].sum()) + int(b[1].sum()) - both)


def similarities(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, similarity) of pairs of keys, from whole texts."""
    left = texts.select(F.col("key").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("key").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
        found = dict(zip(a, batch.column("text_a").to_pylist(), strict=True))
        found.update(zip(b, batch.column("text_b").to_pylist(), strict=True))
        value, owner, count = weights(*shingles(Words(pa.array(list(found.values()), pa.large_string()))))
        bounds = np.searchsorted(owner, np.arange(len(found) + 1))
        sets = {k: (value[i:j], count[i:j]) for k, i, j in zip(found, bounds[:-1], bounds[1:], strict=True)}
        result = [overlap(sets[x], sets[y]) for x, y in zip(a, b, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(result, pa.float64())], ["a", "b", "similarity"])

    return arrow_map(joined, run, "a binary, b binary, similarity double")


def star(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step: every node moves towards the smallest key it can see."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")).filter("a <> b").distinct()
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    moved = large.join(least, "a")
    return moved.select(F.inline(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))).filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(key, component) of every linked key; the component is its smallest key."""
    edges = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before, edges = state, written(star(edges), "edges")
    own = edges.select(F.col("b").alias("key")).distinct().withColumn("component", F.col("key"))
    return edges.select(F.col("a").alias("key"), F.col("b").alias("component")).unionByName(own)


def with_component(df: DataFrame, found: DataFrame) -> DataFrame:
    return df.join(found, "key", "left").withColumn("component", F.coalesce("component", "key"))


def linked_components(docs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Components over the distinct texts (key, doc_id, bands, size)."""
    rows = texts.select("key", F.explode("bands").alias("bucket"))
    many = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = written(rows.join(many, "bucket"), "buckets")
    weight = shared.groupBy("key").agg(F.sum("n").alias("weight"))
    ranked = shared.join(weight, "key")
    pivots = ranked.groupBy("bucket").agg(F.max(F.struct("weight", "key")).getField("key").alias("pivot"))
    sizes = texts.select("key", "size")
    members = written(shared.join(pivots, "bucket").join(sizes, "key").select("bucket", "key", "pivot", "size"), "members")

    # texts that meet another one, once each
    wanted = members.select("key").distinct().join(texts.select("key", "doc_id"), "key").select("doc_id").distinct()
    named = docs.select("doc_id", "text").join(wanted.withColumnRenamed("doc_id", "_wanted"), F.col("doc_id").eqNullSafe(F.col("_wanted")), "left_semi")

    def name(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        listed = batch.column("text").to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array([content_key(t) for t in listed], pa.binary()), batch.column("text")], ["key", "text"])

    whole = written(arrow_map(named.select("text"), name, "key binary, text string").dropDuplicates(["key"]), "texts")

    first = members.filter("key <> pivot").select(F.least("key", "pivot").alias("a"), F.greatest("key", "pivot").alias("b")).distinct()
    links = similarities(first, whole).filter(F.col("similarity") >= similarity - EPS).select("a", "b")
    links = written(links, "links")
    found = written(components(links), "components")
    more = written(open_links(members, found, whole, similarity), "links")
    return found if more.isEmpty() else written(components(links.unionByName(more)), "components")


def open_links(members: DataFrame, found: DataFrame, whole: DataFrame, similarity: float) -> DataFrame:
    """Links between different components that share a bucket, at most a spanning forest per cell.

    In a bucket, the texts of the pivot's component are one side and the others the rest.  Both are cut
    into blocks of ``BLOCK`` texts or ``BLOCK_BYTES`` bytes, and each block of the rest meets each block of
    either side once, in a cell; the pivot's side is never compared with itself.
    """
    own = found.select(F.col("key").alias("pivot"), F.col("component").alias("_main"))
    placed = with_component(members, found).join(own, "pivot", "left").withColumn("_main", F.coalesce("_main", "pivot"))
    placed = placed.select("bucket", "key", "component", "size", (F.col("component") != F.col("_main")).cast("int").alias("rest"))

    def blocks(side: int):
        mine = F.col("rest") == side
        n, size = F.sum(F.when(mine, 1).otherwise(0)), F.sum(F.when(mine, F.col("size")).otherwise(0))
        return F.ceil(F.greatest(n / BLOCK, size / BLOCK_BYTES)).cast("int")

    several = placed.groupBy("bucket").agg(blocks(0).alias("n_main"), blocks(1).alias("n_rest")).filter("n_rest > 0")
    still = placed.join(several, "bucket")
    block = F.pmod(F.xxhash64("key", F.lit(5)), F.when(F.col("rest") == 1, F.col("n_rest")).otherwise(F.col("n_main"))).cast("int")

    def cells(first, side: int, second, n):
        numbers = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(numbers, lambda i: F.struct(first(i).alias("i"), F.lit(side).alias("side"), second(i).alias("j")))

    b = F.col("block")
    of_main = cells(lambda i: i, 0, lambda i: b, F.col("n_rest"))
    with_main = cells(lambda i: b, 0, lambda i: i, F.col("n_main"))
    with_rest = cells(lambda i: F.least(b, i), 1, lambda i: F.greatest(b, i), F.col("n_rest"))
    chosen = F.when(F.col("rest") == 1, F.concat(with_main, with_rest)).otherwise(of_main)
    spread = still.withColumn("block", block).select("bucket", "key", "component", F.explode(chosen).alias("cell"))

    def compare(cell: pa.Table) -> pa.Table:
        a, b = linked_pairs(cell.column("key").to_pylist(), cell.column("component").to_pylist(), cell.column("text"), similarity)
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return spread.join(whole, "key").groupBy("bucket", "cell").applyInArrow(compare, "a binary, b binary").distinct()


def linked_pairs(keys: list[bytes], of: list[bytes], texts: pa.ChunkedArray, similarity: float) -> tuple[list, list]:
    """Pairs of similar texts that join different components into one, one pair per union."""
    value, owner, count = weights(*shingles(Words(texts.combine_chunks())))
    n = len(keys)
    sizes = np.bincount(owner, count, minlength=n)
    # the k-th copy of a shingle is an element of its own; elements of one text alone can't be shared
    element = np.repeat(value, count)
    holder = np.repeat(owner, count)
    turn = np.arange(len(element)) - np.repeat(np.cumsum(count) - count, count)
    name, held = np.unique(mix(element + mix(turn.astype(np.uint64))), return_inverse=True)
    shared = np.bincount(held, minlength=len(name)) > 1
    column = np.cumsum(shared) - 1
    kept = shared[held]
    holder, column = holder[kept], column[held[kept]]
    both = np.zeros((n, n), np.float32)
    order = np.argsort(column, kind="stable")
    holder, column = holder[order], column[order]
    for low in range(0, int(shared.sum()), COLUMNS):
        i, j = np.searchsorted(column, [low, low + COLUMNS])
        part = np.zeros((n, COLUMNS), np.float32)
        part[holder[i:j], column[i:j] - low] = 1
        both += part @ part.T
    alike = both >= (similarity - EPS) * (sizes[:, None] + sizes[None, :] - both)
    names = {c: k for k, c in enumerate(dict.fromkeys(of))}
    label = np.array([names[c] for c in of])
    rows, columns = np.nonzero(alike & (label[:, None] < label[None, :]))
    root = list(range(len(names)))

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    out = []
    for x, y in zip(rows.tolist(), columns.tolist(), strict=True):
        p, q = find(label[x]), find(label[y])
        if p != q:
            root[max(p, q)] = min(p, q)
            out.append((min(keys[x], keys[y]), max(keys[x], keys[y])))
    return [x for x, _ in out], [y for _, y in out]


def groups(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, key, class_id, class_size, keeper_key) of every row; the class id is the smallest id of the class."""
    rows = written(signed(docs), "signed")
    texts = written(rows.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"), F.max("size").alias("size"), F.count(F.lit(1)).alias("copies")), "distinct")
    found = linked_components(docs, texts, similarity)
    placed = with_component(texts.select("key", "doc_id", "copies"), found)
    # the smallest id stays; a missing id only where there is no other
    best = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("key")))
    classes = placed.groupBy("component").agg(best.alias("best"), F.sum("copies").alias("class_size"))
    by_key = placed.join(classes, "component").select("key", "best.doc_id", "class_size", F.col("best.key").alias("keeper_key"))
    by_key = by_key.select("key", F.col("doc_id").alias("class_id"), "class_size", "keeper_key")
    return rows.select("doc_id", "key").join(by_key, "key").select("doc_id", "key", "class_id", "class_size", "keeper_key")


def deduplicate(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row of each class, with all columns of ``docs``."""
    keep = groups(docs, similarity).select(F.col("class_id").alias("_id"), F.col("keeper_key").alias("_key")).distinct()
    ids = keep.groupBy("_id").agg(F.collect_set("_key").alias("_keys"))
    # columns get numbers for names, so that none of theirs meets one of ours
    names = docs.columns
    numbered = [f"c{i}" for i in range(len(names))]
    own = docs.toDF(*numbered)
    doc_id, text = f"c{names.index('doc_id')}", f"c{names.index('text')}"
    near = own.join(ids, F.col(doc_id).eqNullSafe(F.col("_id"))).select(*numbered, "_keys")

    def wanted(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        # of the rows with a class's id, those with the right text
        keys = [content_key(t) for t in batch.column(text).to_pylist()]
        right = [k in ks for k, ks in zip(keys, batch.column("_keys").to_pylist(), strict=True)]
        kept = [batch.column(c) for c in numbered] + [pa.array(keys, pa.binary())]
        yield pa.RecordBatch.from_arrays(kept, [*numbered, "_key"]).filter(pa.array(right, pa.bool_()))

    named = arrow_map(near, wanted, T.StructType([*own.schema.fields, T.StructField("_key", T.BinaryType())]))
    return named.dropDuplicates([doc_id, "_key"]).select(*numbered).toDF(*names)
