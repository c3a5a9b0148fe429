"""Spelling variants: words one edit apart, found by a frontier over a distributed trie (operator 13).

All words and all reversed words form two tries, kept as one edge table (side, node, label, child is a word).
Nodes are prefixes; chains without a branch are one edge, so a long word has few edges.  States
(word, position, node, edits) are joined with the edges of their node, level by level:

* A word starts, without edits, at the nodes of its own path from its middle on.  There it leaves its
  path by an edge whose first letter it does not have: that letter replaces one of the word, is inserted,
  or stands in place of one that is deleted.  The rest of the label must agree.
* With one edit made, labels must agree whole.  A state that ends its word at a node that is a word is a
  neighbour.  The loop ends when no state is left.

Two words one edit apart agree up to the first difference.  If that lies in the word's second half, the
forward trie finds the pair, else the reversed one, where the word's own path is followed to its middle
as well.  So no state begins near the root, and a node is met by few words.  Nodes near the root are always kept and their
edges are dealt out in ``SALTS`` copies.

Prefixes are told apart by a hash only when branches are looked for: a collision adds a node on a chain, which
changes no result.  Nodes, labels and words are compared as they are.

Defined cases: missing and empty texts have no words; repeated rows count each; a missing doc_id never
deletes a letter in ``perturbed``; words without a near word have 0 near words, no form and themselves as root; an
empty table gives no rows; other columns, also ones called ``word`` or ``n``, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mlspark.llm.common import arrow_map, mix
from mlspark.session import written

SHORTEST = 7  # code points of a word
LEAST = 2  # occurrences of a word
FACTOR = 10  # a form is so many times as frequent
LETTERS = "A-Za-z\\u00C0-\\u00FF"
SALTS = 8
HEAD = 2  # letters that an edge tells of what follows it
ASCII = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def occurrences(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """(doc_id, word) for each maximal run of at least ``shortest`` letters, A-Z in lower case."""
    # the look-behind changes no match; it saves tries inside shorter runs
    runs = F.regexp_extract_all(F.col("text"), F.lit(f"(?<![{LETTERS}])[{LETTERS}]{{{shortest},}}+"), F.lit(0))
    return docs.select("doc_id", F.explode(runs).alias("word")).withColumn("word", F.translate("word", *ASCII))


def perturbed(occ: DataFrame) -> DataFrame:
    """The misspellings of the query: by a hash of document and word one word in 31 loses a letter."""
    h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("word")).cast("binary"))
    at = F.pmod(F.col("_h"), F.length("word")).cast("int")
    cut = F.concat(F.left("word", at), F.substring("word", at + 2, F.length("word")))
    rows = occ.withColumn("_h", h)
    return rows.withColumn("word", F.when(F.col("_h") % 31 == 0, cut).otherwise(F.col("word"))).drop("_h")


def counts(occ: DataFrame, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """(word, n) of the words of at least ``shortest`` code points that occur ``least`` times or more."""
    rows = occ.filter(F.length("word") >= shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return rows.filter(F.col("n") >= least)


def prefix_marks(first: int):
    """Arrow function: for each prefix of at least ``first`` letters its hash and the letter after it, -1 at the end."""

    def marks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keys = batch.column("key").to_pylist()
        sizes = np.array([len(k) for k in keys], dtype=np.int64)
        codes = np.frombuffer("".join(keys).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
        starts = np.cumsum(sizes) - sizes
        side = batch.column("side").to_numpy(zero_copy_only=False).astype(np.uint64)
        at = np.arange(len(codes)) - np.repeat(starts, sizes)
        with np.errstate(over="ignore"):
            terms = mix(codes + (at.astype(np.uint64) << np.uint64(32)) + np.repeat(side, sizes) * np.uint64(1 << 31))
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)])
            many = np.maximum(sizes - first + 1, 0)
            row = np.repeat(np.arange(len(keys)), many)
            pos = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many) + first
            place = starts[row] + pos
            hashes = sums[place] - sums[starts[row]]
        after = np.where(pos < sizes[row], np.append(codes, 0)[place].astype(np.int64), -1)
        ids = batch.column("id").to_numpy(zero_copy_only=False)[row]
        columns = [pa.array(ids, pa.int64()), pa.array(pos, pa.int32()), pa.array(hashes.view(np.int64)), pa.array(after, pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, ["id", "pos", "h", "after"])

    return marks


def paths(words: DataFrame, shortest: int) -> DataFrame:
    """(side, key, cuts, more): every word and its mirror, the lengths of its prefixes that are nodes, in order, and
    whether a longer word begins with it."""
    forward = words.select(F.lit(0).alias("side"), F.col("word").alias("key"))
    keys = forward.unionByName(words.select(F.lit(1).alias("side"), F.reverse("word").alias("key")))
    keys = keys.withColumn("id", F.xxhash64("side", "key"))
    near_root = max(shortest // 2, 1) + 1
    marks = arrow_map(keys, prefix_marks(near_root + 1), "id long, pos int, h long, after int")
    kinds = marks.groupBy("h").agg(F.min("after").alias("_low"), F.max("after").alias("_high"))
    nodes = kinds.filter("_low < 0 OR _low <> _high").select("h", (F.col("_high") >= 0).alias("_more"))
    cuts = marks.join(nodes, "h").groupBy("id").agg(F.collect_set("pos").alias("_cuts"), F.max_by("_more", "pos").alias("_more"))
    size = F.length("key")
    upper = F.sequence(F.least(F.lit(near_root - 1), size), F.least(F.lit(near_root), size))
    every = F.array_sort(F.array_union(F.array_union(upper, F.coalesce("_cuts", F.array().cast("array<int>"))), F.array(size)))
    more = F.coalesce("_more", F.lit(True)).alias("more")
    return keys.join(cuts, "id", "left").select("side", "key", F.filter(every, lambda c: c <= size).alias("cuts"), more)


def edges(path: DataFrame) -> DataFrame:
    """(side, node, label, ends, heads): the edges, ``ends`` where the child is a word, and the next two letters of the
    words below it (one where a word ends).  A word that longer ones begin
    with also has an empty label at its node."""
    cuts = F.col("cuts")

    def step(i: Column) -> Column:
        a, b = F.get(cuts, i), F.get(cuts, i + 1)
        head = F.substring("key", b + 1, F.lit(HEAD))
        return F.struct(F.left("key", a).alias("node"), F.substring("key", a + 1, b - a).alias("label"), head.alias("head"))

    steps = F.when(F.size(cuts) > 1, F.transform(F.sequence(F.lit(0), F.size(cuts) - 2), step))
    own = F.array(F.struct(F.col("key").alias("node"), F.lit("").alias("label"), F.lit("").alias("head")))
    none = F.array().cast("array<struct<node:string,label:string,head:string>>")
    rows = path.select("side", F.inline(F.concat(F.coalesce(steps, none), F.when(F.col("more"), own).otherwise(none))))
    heads = F.concat(F.lit(" "), F.array_join(F.sort_array(F.collect_set("head")), " "), F.lit(" ")).alias("heads")
    return rows.groupBy("side", "node", "label").agg(F.max(F.col("head") == "").alias("ends"), heads)


def salts(node: Column, near_root: int) -> Column:
    return F.when(F.length(node) <= near_root, F.lit(SALTS)).otherwise(F.lit(1))


def rest(key: Column | str, pos: Column, length: Column) -> Column:
    """``length`` letters of the word after ``pos``; fewer at its end, so a longer label never agrees."""
    return F.substring(key, pos + 1, length)


def leave(own: DataFrame, edge: DataFrame, near_root: int) -> DataFrame:
    """States with one edit, from the nodes of the words' own paths: (side, key, pos, node, done)."""
    salt = F.pmod(F.xxhash64("key"), salts(F.col("node"), near_root)).cast("int")
    copies = F.explode(F.sequence(F.lit(0), salts(F.col("node"), near_root) - 1)).alias("salt")
    met = own.withColumn("salt", salt).join(edge.select("*", copies), ["side", "node", "salt"])
    key, pos, label = F.col("key"), F.col("pos"), F.col("label")
    size, long = F.length(key), F.length(label)
    first, second = F.left(label, F.lit(1)), F.substring(label, F.lit(2), F.lit(1))
    here, there = rest(key, pos, F.lit(1)), rest(key, pos + 1, F.lit(1))
    # most edges fail on two letters; only the others are compared whole
    likely = (first != here) & ((second == "") | (second == here) | (second == there) | (first == there))
    met = met.filter(F.when(label == "", pos == size - 1).otherwise(likely))
    tail = F.substring(label, F.lit(2), long)
    states = F.array(
        F.when((pos < size) & (tail == rest(key, pos + 1, long - 1)), pos + long),  # another letter
        F.when(tail == rest(key, pos, long - 1), pos + long - 1),  # one letter more
        F.when((pos < size) & (label == rest(key, pos + 1, long)), pos + 1 + long),  # one letter less
    )
    after = F.when(label == "", F.array(size)).otherwise(F.array_compact(states))
    return alive(met.select("side", "key", F.explode(after).alias("pos"), F.concat("node", "label").alias("node"), "ends", "heads"))


def follow(states: DataFrame, edge: DataFrame) -> DataFrame:
    """One level further: labels agree whole."""
    met = states.drop("done").join(edge, ["side", "node"])
    agrees = (F.col("label") != "") & (F.col("label") == rest("key", F.col("pos"), F.length("label")))
    after = (F.col("pos") + F.length("label")).alias("pos")
    return alive(met.filter(agrees).select("side", "key", after, F.concat("node", "label").alias("node"), "ends", "heads"))


def alive(states: DataFrame) -> DataFrame:
    """States at a word's end that are a word, and those below whose node the next letters are as theirs."""
    over = F.col("pos") == F.length("key")
    goes_on = F.contains("heads", F.concat(F.lit(" "), rest("key", F.col("pos"), F.lit(HEAD)), F.lit(" ")))
    return states.filter(F.when(over, F.col("ends")).otherwise(goes_on)).select("side", "key", "pos", "node", over.alias("done"))


def near(words: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """(word, near): all ordered pairs of words that differ by one inserted, deleted or replaced code point.

    ``words`` holds distinct words of at least ``shortest`` code points.
    """
    path = written(paths(words, shortest), "trie-paths")
    edge = written(edges(path), "trie-edges")
    size = F.length("key")
    middle = F.when(F.col("side") == 0, F.floor(size / 2)).otherwise(size - F.floor(size / 2)).cast("int")
    # at a word's own end other words go on only if they begin with it
    kept = F.filter("cuts", lambda c: (c >= middle) & (F.col("more") | (c < size)))
    own = path.select("side", "key", F.explode(kept).alias("pos"))
    states = leave(own.withColumn("node", F.expr("left(key, pos)")), edge, max(shortest // 2, 1) + 1)
    found = None
    while True:
        states = written(states, "frontier")
        done = states.filter("done").select("side", "key", "node")
        found = done if found is None else found.unionByName(done)
        states = states.filter("NOT done")
        if states.isEmpty():
            break
        states = follow(states, edge)
    turn = lambda c: F.when(F.col("side") == 0, F.col(c)).otherwise(F.reverse(c))
    return found.select(turn("key").alias("word"), turn("node").alias("near")).distinct()


def group(words: DataFrame, shortest: int = SHORTEST, factor: int = FACTOR) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of (word, n).

    A word's form is its most frequent near word (ties: the smallest) if that is ``factor`` times as
    frequent; its root is where the forms lead.
    """
    words = written(words.select("word", F.col("n").cast("long").alias("n")), "words")
    others = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))
    seen = near(words.select("word"), shortest).join(others, "near").groupBy("word")
    rows = words.join(seen.agg(F.count(F.lit(1)).alias("n_near"), F.min(best).alias("best")), "word", "left")
    strong = -F.col("best.less") >= F.col("n") * factor
    rows = rows.select(
        "word",
        F.when(strong, F.col("best.form")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, -F.col("best.less")).alias("form_n"),
    )
    rows = written(rows, "forms")
    links = roots(rows.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return rows.join(links, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def roots(links: DataFrame) -> DataFrame:
    """Follows links to their ends, doubling the way in each round; counts grow along a link, so there is no ring."""
    while True:
        links = written(links, "roots")
        further = links.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        ahead = links.join(further, "root", "left")
        if ahead.filter("_next IS NOT NULL").isEmpty():
            return links
        links = ahead.select("word", F.coalesce("_next", "root").alias("root"))
