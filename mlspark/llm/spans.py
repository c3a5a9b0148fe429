"""Matches of a pattern with their places, in DataFrame functions whose work grows with the matches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

POWERS = [1 << k for k in range(31)]  # an array holds less than 2**31 elements


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluates ``value`` once and uses it several times in ``body``."""
    return F.get(F.transform(F.array(value), body), 0)


def running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Prefix results of an array by doubling: after the step of 2**k an element holds the last 2**(k + 1) up to itself."""

    def over(v: Column) -> Column:
        steps = F.filter(F.array(*[F.lit(p) for p in POWERS]), lambda p: p < F.size(v))

        def double(acc: Column, p: Column) -> Column:
            return F.transform(acc, lambda x, i: F.when(i < p, x).otherwise(combine(F.get(acc, i - p), x)))

        return F.aggregate(steps, v, double)

    return let(values, over)


def places(text: Column, pattern: Column | str, measure: Callable[[Column], Column], build: Callable[..., Column]) -> Column:
    """``build(start, end, hit, before, after)`` for each leftmost match, ``before`` and ``after`` being the text between
    matches; ``measure`` gives the length of a piece."""
    regex = pattern if isinstance(pattern, Column) else F.lit(pattern)
    pair = F.struct(F.regexp_extract_all(text, regex, F.lit(0)).alias("hits"), F.split(text, regex, -1).alias("parts"))

    def of(p: Column) -> Column:
        steps = F.transform(p["hits"], lambda hit, i: measure(F.get(p["parts"], i)) + measure(hit))
        ends = running(steps, lambda a, b: a + b)

        def place(e: Column) -> Column:
            def one(hit: Column, i: Column) -> Column:
                end = F.get(e, i)
                return build(end - measure(hit), end, hit, F.get(p["parts"], i), F.get(p["parts"], i + 1))

            return F.transform(p["hits"], one)

        return let(ends, place)

    return let(pair, of)
