"""Licences by ordered signature rules, all in DataFrame functions (operator 12).

A text becomes its words in lower case, one blank apart.  A rule has a kind, a label, words that must all be
in the text, and a pattern over that form.  One pass gathers which of the rules' words a text holds; only
rules whose words are all there are tried.  A detection is the word interval of a match.  Kinds are ranked:
passages of licence texts, tags, addresses, names with a version, names, phrases.  A detection within the
interval of one of its own or a better rank goes (equal intervals: the earlier rule stays).  What is left
gives the labels; the score is the greatest weight of a kind among it.

Places come from running sums by doubling (``spans.running``), so the work for n matches in a text grows with
n log n, also for suppression: detections are sorted, and the furthest end so far of each rank tells
whether a detection lies within an earlier one.

Defined cases: a missing text is empty; a text without words or detections has no labels, score 0 and the
empty string for both label lists; repeated rows give a row each; a missing doc_id is kept; an empty
table gives no rows; other columns, also ones called ``labels`` or ``score``, are ignored.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mlspark.llm import license_rules as L
from mlspark.llm.spans import let, places, running

KINDS = ["notice", "tag", "url", "version", "name", "phrase"]
WEIGHTS = [1.0, 0.95, 0.9, 0.85, 0.7, 0.5]
PHRASE = len(KINDS) - 1
ASCII = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# what stands between words of a text in lower case
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
DETECTION = "array<struct<start:int,less:int,rank:int,rule:int,label:string>>"


@dataclass(frozen=True)
class Rule:
    kind: int
    label: str
    words: tuple[str, ...]
    pattern: str


def table(kind: int, lines: str) -> list[Rule]:
    rules = []
    for line in lines.strip().splitlines():
        label, words, pattern = line.split("; ", 2)
        rules.append(Rule(kind, label, tuple(words.split()), pattern))
    return rules


def spoken(identifier: str) -> str:
    """The words of an identifier."""
    return " ".join(re.findall("[a-z0-9]+", identifier.lower()))


def identifier_rules() -> list[Rule]:
    """Tags and manifest fields of short identifiers; a longer identifier does not match a shorter one's rule."""
    names = L.IDENTIFIERS + [f"CC-{k}-{v}".upper() for k in L.CC_KINDS for v in L.CC_VERSIONS]
    every = [spoken(n) for n in names]
    rules = []
    for name, words in zip(names, every, strict=True):
        longer = [w[len(words) :] for w in every if w.startswith(words + " ")]
        stop = f"(?!{'|'.join(sorted(longer))})" if longer else ""
        key = words.split()[0]
        rules.append(Rule(1, name.lower(), ("spdx", key), f"spdx license identifier {words}{stop}"))
        rules.append(Rule(1, name.lower(), ("license", key), f"(?:package |project )?license (?:expression |text |id |name )?{words}{stop}"))
    return rules


def cc_rules() -> list[Rule]:
    """The licences of one family: every kind and version as address, short form and full name."""
    rules = []
    for kind in L.CC_KINDS:
        parts = kind.split("-")
        dashed, full = " ".join(parts), " ".join(L.CC_PARTS[p] for p in parts)
        for version in L.CC_VERSIONS:
            label, number = f"cc-{kind}-{version}", version.replace(".", " ")
            rules.append(Rule(2, label, ("creativecommons", "licenses"), f"creativecommons org licenses {dashed} {number}"))
            rules.append(Rule(3, label, ("cc",), f"cc {dashed} {number}"))
            rules.append(Rule(3, label, ("creative", "commons"), f"creative commons {full} {number}"))
        rules.append(Rule(4, f"cc-{kind}", ("cc",), f"cc {dashed}"))
        rules.append(Rule(4, f"cc-{kind}", ("creative", "commons"), f"creative commons {full}"))
    return rules


def all_rules() -> list[Rule]:
    """The rules in order: by kind, then as they are written."""
    rules = table(0, L.NOTICES) + identifier_rules() + table(2, L.URLS) + table(3, L.VERSIONS) + cc_rules()
    rules += table(4, L.NAMES) + table(PHRASE, L.BASE)
    return sorted(rules, key=lambda r: r.kind)


def words(text: Column, gap: str) -> Column:
    return F.filter(F.split(text, gap, -1), lambda w: w != "")


def blanks(piece: Column) -> Column:
    return F.length(piece) - F.length(F.replace(piece, F.lit(" "), F.lit("")))


def detections(form: Column, present: Column, rules: list[Rule]) -> Column:
    """Matches of all rules whose words are present, by start, longest first, then by rule."""
    rows = [{"rule": i, "rank": r.kind, "label": r.label, "words": r.words, "pattern": f"(?<= )(?:{r.pattern})(?= )"} for i, r in enumerate(rules)]
    schema = "array<struct<rule:int,rank:int,label:string,words:array<string>,pattern:string>>"
    every = F.from_json(F.lit(json.dumps(rows)), schema)
    tried = F.filter(every, lambda r: F.forall(r["words"], lambda w: F.array_contains(present, w)))

    def find(r: Column) -> Column:
        def build(start: Column, end: Column, hit: Column, before: Column, after: Column) -> Column:
            # the first blank stands before the first word; a match of w words holds w - 1 blanks
            return F.struct(
                (start - 1).alias("start"), (1 - end).alias("less"), r["rank"].alias("rank"), r["rule"].alias("rule"), r["label"].alias("label")
            )

        return places(form, r["pattern"], blanks, build)

    return F.array_sort(F.flatten(F.transform(tried, find)))


def standing(found: Column) -> Column:
    """Detections that no earlier one of their own or a better rank holds."""
    ranks = range(len(KINDS))
    ends = F.transform(found, lambda d: F.array(*[F.when(d["rank"] <= k, -d["less"]).otherwise(F.lit(-1)) for k in ranks]))
    furthest = running(ends, lambda a, b: F.zip_with(a, b, lambda x, y: F.greatest(x, y)))

    def of(far: Column) -> Column:
        return F.filter(found, lambda d, i: (i == 0) | (F.get(F.get(far, i - 1), d["rank"]) < -d["less"]))

    return let(furthest, of)


def scan(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """(doc_id, n_words, found, kept) of every row: all detections and those that stay.

    A detection is (start, less, rank, rule, label): first word, minus the last word, kind, rule number, label.
    """
    rules = all_rules() if rules is None else rules
    gates = F.array(*[F.lit(w) for w in sorted({w for r in rules for w in r.words})])
    rows = docs.select(F.col("doc_id").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # lower() also turns letters other than A-Z, which adds no gap and can only let more rules be tried
    rows = rows.withColumn("_words", words(F.lower("text"), GAP))
    rows = rows.select("doc_id", "text", F.size("_words").cast("long").alias("n_words"), F.array_intersect("_words", gates).alias("_present"))
    form = F.concat(F.lit(" "), F.array_join(words(F.translate("text", *ASCII), GAP), " "), F.lit(" "))
    found = let(form, lambda f: detections(f, F.col("_present"), rules))
    none = F.array().cast(DETECTION)
    rows = rows.select("doc_id", "n_words", F.when(F.size("_present") > 0, found.cast(DETECTION)).otherwise(none).alias("found"))
    return rows.withColumn("kept", F.when(F.size("found") > 0, standing(F.col("found"))).otherwise(none))


def listed(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def report(scanned: DataFrame) -> DataFrame:
    """Places and labels of the base phrases, all labels, and the score."""
    base = F.filter("found", lambda d: d["rank"] == PHRASE)
    rows = scanned.withColumn("_base", base)
    starts = F.transform("_base", lambda d: d["start"])
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    named = F.concat(F.transform("_base", lambda d: d["label"]), F.transform("kept", lambda d: d["label"]))
    return rows.select(
        "doc_id",
        "n_words",
        F.size("_base").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        listed(F.transform("_base", lambda d: d["label"])).alias("base_labels"),
        listed(named).alias("labels"),
        F.coalesce(F.array_max(F.transform("kept", lambda d: F.get(weights, d["rank"]))), F.lit(0.0)).alias("score"),
    )
