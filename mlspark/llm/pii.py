"""Personal data: rules, wider candidates and boosted trees, all in DataFrame functions (operator 2).

Base spans are the leftmost non-overlapping matches of four patterns that pass their checks.  Generators
of high recall propose further spans, which may overlap: numbers in other spellings, written-out mail
addresses and hexadecimal address groups.  Gradient-boosted trees rate a candidate by format and context.

The tables mark no personal data, so the trees learn from made cases in real contexts:

* True: a base span is written in another way and put back between the letters around it: mail addresses with
  "(at)" and "dot", phone numbers without plus, cards and net addresses with other separators, net
  addresses in hexadecimal groups.
* False: plain numbers, dates, times, amounts and half sentences with "at" and a full stop, put into texts without
  base spans, at a place given by a hash.
* Candidates of the texts themselves that are no base span are unlabelled and take no part.

A threshold for each generator, set on cases kept from the fit for a precision of ``PRECISION``, selects the
candidates to add; one that overlaps a base span adds nothing and is left out.  Trees and thresholds are fitted on
the cases of all texts, and applied as a column expression, so every text is read and rated inside the scan.
Positions are code points, ends exclusive; they come from running sums by doubling, so n matches cost n log n.

Defined cases: a missing text is empty; it has no spans and the digest of the empty string; equal texts
give equal spans; without cases of both classes nothing is added to the base spans; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mlspark.llm.spans import let, places, running
from mlspark.plans.ordered import running_sums
from mlspark.session import written

ROUNDS, DEPTH, BINS = 12, 3, 32
PRECISION = 0.99
FOLDS = 4  # one of so many sets the thresholds

# the base patterns; possessive repeats and the look-behind change no match, they only avoid useless retries
LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": (rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": (r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "."),
    "card": (r"[0-9](?:[ -]?[0-9])++", None),
    "phone": (r"\+[0-9][ ().0-9-]+[0-9]", "+"),
}
# repeated groups are possessive: a greedy one would recurse once for each repeat
GENERATORS = {
    "number": (r"[+(]?[0-9](?:[ ()./-]{0,2}[0-9]){6,24}", None),
    "spelled": (
        rf"(?i)(?<!{LOCAL}){LOCAL}++ ?(?:@|\(at\)|\[at\]| at ) ?[A-Za-z0-9-]++(?: ?(?:\.|\(dot\)|\[dot\]| dot ) ?[A-Za-z0-9-]++)++",
        None,
    ),
    "groups": (r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){3,7}", ":"),
}
KINDS = [*BASE, *GENERATORS]
FEATURES = (
    "length digits letters spaces dashes dots slashes brackets colons plus at groups checksum grouped "
    "spelled_at spelled_dot cue_phone cue_mail cue_card cue_net after_digit before_digit before_letter after_letter generator"
).split()
SPAN = "array<struct<start:int,end:int,hit:string,before:string,after:string>>"


def occurrences(text: Column, pattern: str, needs: str | None) -> Column:
    """Matches with their position and neighbouring characters; ``needs`` is a text that every match holds."""

    def build(start: Column, end: Column, hit: Column, before: Column, after: Column) -> Column:
        near = [F.right(before, F.lit(24)).alias("before"), F.left(after, F.lit(12)).alias("after")]
        return F.struct(start.alias("start"), end.alias("end"), hit.alias("hit"), *near)

    found = places(text, pattern, F.length, build).cast(SPAN)
    return F.when(F.contains(text, F.lit(needs)), found).otherwise(F.array().cast(SPAN)) if needs else found


def digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the checksum: from the right, every second digit is doubled."""

    def total(text: Column) -> Column:
        def add(acc: Column, i: Column) -> Column:
            d = F.substring(text, i, F.lit(1)).cast("int")
            twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
            return acc + F.when(i % 2 == 0, twice).otherwise(d)

        return F.aggregate(F.sequence(F.lit(1), F.length(text)), F.lit(0), add) % 10 == 0

    return let(F.reverse(number), total)


def passes(kind: str, hit: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(hit, r"\."), lambda part: part.cast("double") <= 255)
    if kind == "card":
        return let(digits(hit), lambda d: F.when(F.length(d).between(12, 19), luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.length(digits(hit)).between(9, 15)
    return F.lit(True)


def base_hits(text: Column) -> Column:
    """Base matches of all kinds: start, kind, end, hit, before, after."""

    def of(k: int, kind: str) -> Column:
        good = F.filter(occurrences(text, *BASE[kind]), lambda s: passes(kind, s["hit"]))
        return F.transform(good, lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("kind"), *[s[f].alias(f) for f in ("end", "hit", "before", "after")]))

    return F.concat(*[of(k, kind) for k, kind in enumerate(BASE)])


def base_spans(text: Column) -> Column:
    """All base spans, by start and then by kind."""
    return in_order(F.transform(base_hits(text), lambda s: F.struct(*[s[f].alias(f) for f in ("start", "kind", "end")])))


def in_order(spans: Column) -> Column:
    return F.array_sort(spans)  # structs compare by start, kind, end


def count_of(text: Column, chars: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{chars}]", ""))


def features(s: Column) -> Column:
    """The values of ``FEATURES`` for one candidate, as doubles."""
    hit, before, after = s["hit"], s["before"], s["after"]
    number = digits(hit)
    checksum = F.when(F.length(number).between(12, 19), luhn(number)).otherwise(F.lit(False))
    last, first = F.right(before, F.lit(1)), F.left(after, F.lit(1))
    values = [
        F.length(hit),
        F.length(number),
        count_of(hit, "A-Za-z"),
        count_of(hit, " "),
        count_of(hit, "-"),
        count_of(hit, "."),
        count_of(hit, "/"),
        count_of(hit, "()"),
        count_of(hit, ":"),
        hit.startswith("+"),
        hit.contains("@"),
        F.size(F.split(hit, "[^0-9A-Za-z]+", -1)),
        checksum,
        hit.rlike(r"^[0-9]{3,4}([ -][0-9]{3,4}){2,4}$"),
        hit.rlike(r"(?i)[^a-z]at[^a-z]"),
        hit.rlike(r"(?i)[^a-z]dot[^a-z]"),
        before.rlike(r"(?i)(tel|phone|fon|call|mob|fax)"),
        before.rlike(r"(?i)(mail|contact|write)"),
        before.rlike(r"(?i)(card|visa|account|iban|konto)"),
        before.rlike(r"(?i)(ip|host|server|addr)"),
        first.rlike("[0-9]"),
        last.rlike("[0-9.+]"),
        last.rlike("[A-Za-z]"),
        first.rlike("[A-Za-z]"),
        s["kind"] - len(BASE),
    ]
    return F.array(*[v.cast("double") for v in values])


def candidate_spans(text: Column, base: Column) -> Column:
    """Candidates of all generators: start, kind, end, features, and whether a base span overlaps.

    Base spans stand at their start, candidates at their last character; a candidate is overlapped if the furthest
    end of the base spans up to its place lies behind its start.
    """
    fields = ("start", "kind", "end", "hit", "before", "after")
    item = f"array<struct<at:int,candidate:boolean,span:struct<{','.join(f + (':int' if f in fields[:3] else ':string') for f in fields)}>>>"

    def entry(s: Column, kind: Column, at: Column, candidate: bool, *texts: Column) -> Column:
        return F.struct(at.alias("at"), F.lit(candidate).alias("candidate"), F.struct(s["start"], kind, s["end"], *texts).alias("span"))

    def proposed(k: int) -> Callable[[Column], Column]:
        return lambda s: entry(s, F.lit(len(BASE) + k), s["end"] - 1, True, s["hit"], s["before"], s["after"])

    parts = [F.transform(base, lambda s: entry(s, s["kind"], s["start"], False, *[F.lit("")] * 3)).cast(item)]
    for k, name in enumerate(GENERATORS):
        parts.append(F.transform(occurrences(text, *GENERATORS[name]), proposed(k)).cast(item))

    def of(every: Column) -> Column:
        ends = F.transform(every, lambda e: F.when(e["candidate"], -1).otherwise(e["span"]["end"]))

        def rate(far: Column) -> Column:
            def one(e: Column, i: Column) -> Column:
                s = e["span"]
                values = [s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")]
                return F.when(e["candidate"], F.struct(*values, (F.get(far, i) > s["start"]).alias("over"), features(s).alias("features")))

            return F.array_compact(F.transform(every, one))

        return let(running(ends, F.greatest), rate)

    return let(F.array_sort(F.concat(*parts)), of)


def tree_value(lines: list[str], x: Column) -> Column:
    """A printed regression tree as a column over the feature array ``x``."""
    line = lines.pop(0).strip()
    if line.startswith("Predict:"):
        return F.lit(float(line.split(":")[1]))
    index, cut = re.match(r"If \(feature (\d+) <= (\S+)\)", line).groups()
    below = tree_value(lines, x)
    lines.pop(0)  # the matching Else
    return F.when(F.get(x, F.lit(int(index))) <= float(cut), below).otherwise(tree_value(lines, x))


class Boosted:
    """Fitted trees and the threshold of each generator; without trees nothing is selected."""

    def __init__(self, trees: list[tuple[float, str]], thresholds: list[float]) -> None:
        self.trees, self.thresholds = trees, thresholds

    def score(self, x: Column) -> Column:
        margin = F.lit(0.0)
        for weight, printed in self.trees:
            margin = margin + tree_value(printed.splitlines()[1:], x) * weight
        return 1 / (1 + F.exp(margin * -2))

    def selects(self, c: Column) -> Column:
        if not self.trees:
            return F.lit(False)
        cut = F.get(F.array(*[F.lit(t) for t in self.thresholds]), c["kind"] - len(BASE))
        return ~c["over"] & (self.score(c["features"]) >= cut)


def threshold(rated: list[tuple[float, int]], precision: float = PRECISION) -> float:
    """The smallest score from which on the share of true candidates reaches ``precision``; 2 if none does.

    The plain form of ``thresholds``, which is held against it."""
    best, true, n = 2.0, 0, 0
    for i, (value, label) in enumerate(rows := sorted(rated, reverse=True)):
        true, n = true + label, n + 1
        last = i + 1 == len(rows) or rows[i + 1][0] < value
        if last and true >= precision * n:
            best = value
    return best


def thresholds(rated: DataFrame, precision: float = PRECISION) -> list[float]:
    """``threshold`` of each generator over a table (kind, score, label); equal scores are added up before they are ordered."""
    sums = rated.groupBy("kind", "score").agg(F.sum("label").alias("hits"), F.count(F.lit(1)).alias("rows"))
    totals = {"true": F.col("hits"), "n": F.col("rows")}
    summed = running_sums(written(sums, "scores"), ["kind"], "score", totals, descending=True)
    cuts = summed.filter(F.col("true") >= precision * F.col("n")).groupBy("kind").agg(F.min("score").alias("score"))
    found = {r["kind"]: r["score"] for r in cuts.collect()}
    return [found.get(len(BASE) + k, 2.0) for k in range(len(GENERATORS))]


def with_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, base, candidates) of every row."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.select("doc_id", "text", base_spans(F.col("text")).alias("base")).select(
        "doc_id", "base", candidate_spans(F.col("text"), F.col("base")).alias("candidates")
    )


def pick(place: Column, options: list[str | Column]) -> Column:
    """One of the options, by a hash."""
    return F.get(F.array(*[o if isinstance(o, Column) else F.lit(o) for o in options]), F.pmod(place, F.lit(len(options))).cast("int"))


def rewritten(hit: Column, kind: Column, place: Column) -> Column:
    """A base span in another spelling."""
    at = pick(place, [" (at) ", " [at] ", " at ", "(at)", "@"])
    dot = pick(F.shiftright(place, 8), [" dot ", " (dot) ", "[dot]", " dot "])
    gap = pick(place, ["/", ".", " / ", "-", " "])
    host = F.substring_index(hit, "@", -1)
    host = F.when(F.pmod(F.shiftright(place, 20), F.lit(2)) == 0, host).otherwise(F.substring_index(host, ".", -2))
    host = F.replace(host, F.lit("."), dot)
    email = F.concat(F.substring_index(hit, "@", 1), at, host)
    phone = F.ltrim(F.regexp_replace(F.substring(hit, F.lit(2), F.length(hit)), "[ ().-]+", pick(place, [" ", "-", "/", "."])))
    card = F.regexp_replace(digits(hit), "(.{4})(?=.)", F.concat(F.lit("$1"), pick(place, ["/", ".", "  ", "--"])))
    parts = F.transform(F.split(hit, r"\."), lambda p: F.lower(F.hex(p.cast("int"))))
    net = F.when(F.pmod(F.shiftright(place, 16), F.lit(2)) == 0, F.array_join(parts, ":")).otherwise(F.replace(hit, F.lit("."), F.concat(F.trim(gap), F.lit(" "))))
    return F.when(kind == 0, email).when(kind == 1, net).when(kind == 2, card).otherwise(phone)


def plain(place: Column, text: Column) -> Column:
    """Something that a generator proposes and that is no personal data; words come from the text."""
    d = F.concat(F.abs(place).cast("string"), F.lit("7351908264"))

    def cut(a: int, n: int) -> Column:
        return F.substring(d, a, n)

    def number(low: int, span: int, a: int) -> Column:
        return F.lpad((F.pmod(cut(a, 4).cast("int"), F.lit(span)) + low).cast("string"), 2, "0")

    word = F.regexp_extract(F.substring(text, F.pmod(place, F.lit(997)).cast("int") + 1, F.lit(200)), r"([A-Za-z]{2,}) ([A-Za-z]{2,}) ([A-Za-z]{2,})", 0)
    words = F.split(word, " ")
    a, b, c = [F.when(word == "", F.lit(w)).otherwise(F.get(words, i)) for i, w in enumerate(("seen", "noon", "then"))]
    year = (F.pmod(cut(1, 4).cast("int"), F.lit(130)) + 1900).cast("string")
    return pick(
        F.shiftright(place, 4),
        [
            cut(1, 8),
            F.concat(cut(1, 1), F.lit(" "), cut(2, 3), F.lit(" "), cut(5, 3)),
            F.concat(cut(1, 3), F.lit("."), cut(4, 3), F.lit("."), cut(7, 3)),
            F.concat(year, F.lit("-"), number(1, 12, 3), F.lit("-"), number(1, 28, 5), F.lit(" "), number(0, 24, 7), F.lit(" "), number(0, 60, 2)),
            F.concat(number(1, 28, 5), F.lit("/"), number(1, 12, 3), F.lit("/"), year),
            F.concat(number(1, 28, 5), F.lit("."), number(1, 12, 3), F.lit("."), year),
            F.concat(year, F.lit("-"), (year.cast("int") + 1).cast("string")),
            cut(1, 14),
            cut(1, 16),
            cut(1, 16),
            F.concat_ws(" ", cut(1, 4), cut(5, 4), cut(9, 4), cut(13, 4)),
            F.concat_ws("-", cut(1, 4), cut(5, 4), cut(9, 4), cut(13, 4)),
            F.concat(number(0, 24, 1), F.lit(":"), number(0, 60, 3), F.lit(":"), number(0, 60, 5), F.lit(":"), number(0, 60, 7)),
            F.concat(number(1, 9, 1), F.lit(":"), number(1, 9, 3), F.lit(":"), number(1, 9, 5), F.lit(":"), number(1, 9, 2), F.lit(":"), number(1, 9, 4)),
            F.concat(a, F.lit(" at "), b, F.lit(". "), F.initcap(c)),
            F.concat(a, F.lit(" at "), b, F.lit("."), c),
            F.concat(a, F.lit(" @ "), b, F.lit(" . "), F.initcap(c)),
        ],
    )


def cases(docs: DataFrame, sample: int | None = None) -> DataFrame:
    """The made cases of all texts: (label, place, before, made, after).  With ``sample``, half as many of each class at most."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("hits", base_hits(F.col("text")))
    spans = texts.select("doc_id", F.explode("hits").alias("h")).withColumn("place", F.xxhash64("doc_id", "h.start", "h.kind"))
    true = spans.select(F.lit(1).alias("label"), "place", "h.before", rewritten(F.col("h.hit"), F.col("h.kind"), F.col("place")).alias("made"), "h.after")
    neutral = texts.filter(F.size("hits") == 0).select("text", F.explode(F.sequence(F.lit(1), F.lit(2))).alias("i"), F.xxhash64("doc_id", "text", "i").alias("place"))
    at = F.pmod(F.shiftright("place", 3), F.greatest(F.length("text") - 36, F.lit(1))).cast("int") + 1
    before, after = F.concat(F.substring("text", at, F.lit(23)), F.lit(" ")), F.concat(F.lit(" "), F.substring("text", at + 23, F.lit(11)))
    around = [before.alias("before"), plain(F.col("place"), F.col("text")).alias("made"), after.alias("after")]
    halves = [true, neutral.select(F.lit(0).alias("label"), "place", *around)]
    if sample is not None:
        halves = [part.orderBy("place", "before", "made", "after").limit(sample // 2) for part in halves]
    return written(halves[0].unionByName(halves[1]), "cases")


def described(made: DataFrame) -> DataFrame:
    """The candidates that the generators propose for the made spans, with their features.

    One that reaches from a false span into the text around it, or passes the checksum by chance, is unlabelled.
    """
    rows = made.withColumn("text", F.concat("before", "made", "after")).withColumn("at", F.length("before"))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    rows = rows.select("label", "place", "at", (F.col("at") + F.length("made")).alias("to"), F.inline(candidate_spans(F.col("text"), none)))
    return rows.filter("start < to AND at < end AND (label = 1 OR (at <= start AND end <= to))").filter(
        (F.col("label") == 1) | (F.get("features", F.lit(FEATURES.index("checksum"))) == 0)
    ).select("label", "place", "kind", "features")


def fit(docs: DataFrame, sample: int | None = None) -> Boosted:
    """Trees and thresholds from made cases in the contexts of all texts."""
    vector = VectorAssembler(inputCols=FEATURES, outputCol="vector")
    table = described(cases(docs, sample))
    table = table.select(F.col("label").cast("double").alias("label"), "kind", "place", *[F.get("features", F.lit(i)).alias(n) for i, n in enumerate(FEATURES)])
    table = written(vector.transform(table).select("label", "kind", "place", "vector"), "candidates")
    fold = F.pmod(F.xxhash64("place"), F.lit(FOLDS))
    fitting, kept = table.filter(fold != 0), table.filter(fold == 0)
    if fitting.select("label").distinct().count() < 2:
        return Boosted([], [])
    model = GBTClassifier(featuresCol="vector", maxIter=ROUNDS, maxDepth=DEPTH, maxBins=BINS, stepSize=0.3, seed=5).fit(fitting)
    trees = [(w, t.toDebugString) for w, t in zip(model.treeWeights, model.trees, strict=True)]
    rated = model.transform(kept).select("kind", F.col("label").cast("int").alias("label"), vector_to_array("probability")[1].alias("score"))
    return Boosted(trees, thresholds(rated))


def written_out(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def find(docs: DataFrame, model: Boosted) -> DataFrame:
    """Counts and digest of the base spans, and all spans, of every row."""
    spans = with_spans(docs)
    kept = F.filter("candidates", model.selects)
    added = F.transform(kept, lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end")))

    def count(k: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(BASE)]
    digest = F.sha2(written_out(F.col("base")).cast("binary"), 256).alias("base_sha256")
    return spans.select("doc_id", *counts, digest, written_out(in_order(F.concat("base", added))).alias("spans"))


def detect(docs: DataFrame, sample: int | None = None) -> DataFrame:
    return find(docs, fit(docs, sample))
