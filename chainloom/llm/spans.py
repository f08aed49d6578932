"""Matches of a regular expression with their code-point positions, by built-in functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Sums that make one of the next level, and levels: the last has few sums for any text that fits in a row.
STEP, LEVELS = 64, 4
CONTEXT = 40


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _total(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0), lambda a, x: a + x)


def matches(text: Column, pattern: str, group: int | None = None) -> Column:
    """array<struct<start, end, match, sub, before, after>> of all leftmost, non-overlapping matches, in order.

    start and end count code points, end exclusive; sub is the given group; before and after are up to CONTEXT code points
    around the match, as far as the neighbouring matches. The pattern must not match an empty string. Positions are sums of
    the lengths of the matches and of what lies between them. These are added up by runs of STEP, runs of runs, and so on, and
    a position takes less than STEP sums of each kind, so the time grows with the number of matches.
    """
    p = F.lit(pattern)
    found = F.struct(
        F.regexp_extract_all(text, p, F.lit(0)).alias("m"),
        (F.regexp_extract_all(text, p, F.lit(group)) if group else F.array().cast("array<string>")).alias("g"),
        F.split(text, pattern, -1).alias("gaps"),
    )

    def runs(sums: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor(F.size(sums) / STEP).cast("int")), lambda r: _total(F.slice(sums, r * STEP + 1, F.lit(STEP))))

    def placed(v: Column, sums: list[Column]) -> Column:
        if len(sums) < LEVELS:
            return let(runs(sums[-1]), lambda more: placed(v, [*sums, more]))

        def span(x: Column, i: Column) -> Column:
            start = F.length(F.get(v["gaps"], i))
            for level, s in enumerate(sums):
                run = F.floor(i / STEP ** (level + 1)).cast("int") * STEP if level < LEVELS - 1 else F.lit(0)
                start = start + _total(F.slice(s, run + 1, F.floor(i / STEP**level).cast("int") - run))
            return F.struct(
                start.alias("start"), (start + F.length(x)).alias("end"), x.alias("match"), F.get(v["g"], i).alias("sub"),
                F.substring(F.get(v["gaps"], i), -CONTEXT, CONTEXT).alias("before"), F.substring(F.get(v["gaps"], i + 1), 1, CONTEXT).alias("after"),
            )

        return F.transform(v["m"], span)

    return let(found, lambda v: let(F.transform(v["m"], lambda x, j: F.length(F.get(v["gaps"], j)) + F.length(x)), lambda steps: placed(v, [steps])))


def listed(spans: Column, order: tuple[str, ...]) -> Column:
    """`kind:start:end` of array<struct<kind, start, end, ...>>, comma-joined; order: the fields and kinds to sort by."""
    keyed = F.transform(spans, lambda s: F.struct(*[F.array_position(F.array(*map(F.lit, order[1:])), s["kind"]).alias("o") if f == "kind" else s[f].alias("s") for f in order[0].split(",")], s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return F.array_join(F.transform(F.sort_array(keyed), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
