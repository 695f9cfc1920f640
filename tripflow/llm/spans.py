"""Matches of a pattern with their positions, by SQL functions alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 256
SPANS = "array<struct<start:int,end:int,value:string>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is named there."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(lengths: Column) -> Column:
    """0 and the sums of the first 1, 2, ... numbers of an array."""
    return F.aggregate(lengths, F.array(F.lit(0)),
                       lambda sums, n: F.concat(sums, F.array(F.element_at(sums, -1) + n)))


def prefix_sums(lengths: Column) -> Column:
    """What stands before each number of a non-empty array, in sum. By blocks,
    so that long arrays cost in proportion to their length."""
    def blocks(all_: Column) -> Column:
        first = F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / BLOCK).cast("int"))
        return F.transform(first, lambda b: _running(F.slice(all_, b * BLOCK + 1, BLOCK)))

    def shifted(inner: Column) -> Column:
        bases = _running(F.transform(F.slice(inner, 1, F.size(inner) - 1), lambda sums: F.element_at(sums, -1)))
        return F.flatten(F.zip_with(inner, bases, lambda sums, base: F.transform(
            F.slice(sums, 1, F.size(sums) - 1), lambda s: s + base)))

    return let(let(lengths, blocks), shifted)


def _gaps_and_matches(text: Column, pattern: str) -> Column:
    """What stands before each match, and the match; last, the rest and a null."""
    return F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                      lambda gap, m: F.struct(gap.alias("gap"), m.alias("value")))


def matches(text: Column, pattern: str) -> Column:
    """The leftmost non-overlapping matches of a Java pattern in a text, as
    ``array<struct<start, end, value>>``: code points, end exclusive. The
    pattern must not match the empty string. Null texts have no matches."""
    def placed(found: Column) -> Column:
        steps = F.transform(found, lambda m: F.length(m["gap"]) + F.length(m["value"]))
        return F.zip_with(found, F.when(F.size(found) > 0, prefix_sums(steps)).otherwise(F.array().cast("array<int>")), lambda m, base: let(base + F.length(m["gap"]), lambda start: F.struct(
            start.alias("start"), (start + F.length(m["value"])).alias("end"), m["value"].alias("value"))))

    spans = let(text, lambda t: F.when(t.rlike(pattern), let(F.filter(
        _gaps_and_matches(t, pattern), lambda m: m["value"].isNotNull()), placed)))
    return F.coalesce(spans, F.array()).cast(SPANS)


def masked(text: Column, pattern: str) -> Column:
    """The text with each match blanked, at its length."""
    def blanked(t: Column) -> Column:
        parts = F.transform(_gaps_and_matches(t, pattern), lambda m: F.concat(
            m["gap"], F.coalesce(F.repeat(F.lit(" "), F.length(m["value"])), F.lit(""))))
        return F.when(t.rlike(pattern), F.array_join(parts, "")).otherwise(t)
    return let(text, blanked)


def replaced(text: Column, spans: Column) -> Column:
    """The text with spans (``start``, ``end``, ``label``) replaced by their
    labels; of spans that overlap, the first one's label stands for all."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def rebuilt(chars: Column) -> Column:
        def step(state: Column, s: Column) -> Column:
            gap = F.array_join(F.slice(chars, state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0))), "")
            clear = s["start"] >= state["at"]
            return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.when(clear, F.concat(
                state["out"], F.array(gap, s["label"]))).otherwise(state["out"]).alias("out"))

        def end(state: Column) -> Column:
            rest = F.array_join(F.slice(chars, state["at"] + 1, F.greatest(F.size(chars) - state["at"], F.lit(0))), "")
            return F.concat(F.array_join(state["out"], ""), rest)

        return F.aggregate(F.array_sort(spans), start, step, end)

    return F.when(F.size(spans) > 0, let(F.split(text, ""), rebuilt)).otherwise(text)


def count_of(spans: str, kind: str) -> Column:
    """How many spans of a kind the column has."""
    return F.size(F.filter(F.col(spans), lambda s: s["kind"] == kind)).cast("long")


def joined(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
