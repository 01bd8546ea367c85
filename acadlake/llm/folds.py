"""Folds over long arrays as native expressions.

A fold that appends to an array copies it at every step.  Cutting the array into about sqrt(n) chunks, folding each
chunk from its own starting value, and joining the results bounds the copying by n * sqrt(n) small elements; a chunk
also takes its own block of the text once, so that no step counts characters from the beginning of a long text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def chunks(arr: Column) -> Column:
    """A non-empty array in about sqrt(n) pieces."""
    n = F.size(arr)
    step = F.greatest(F.lit(1), F.ceil(F.sqrt(n)).cast("int"))
    return F.transform(F.sequence(F.lit(0), F.floor((n - 1) / step).cast("int")), lambda i: F.slice(arr, i * step + 1, step))


def before(values: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """For each value what ``merge`` makes, from 0, of those before it."""
    start = F.struct(F.lit(0).cast("bigint").alias("now"), F.array().cast("array<bigint>").alias("out"))
    return F.aggregate(values, start, lambda a, x: F.struct(
        merge(a["now"], x).alias("now"), F.concat(a["out"], F.array(a["now"])).alias("out")), lambda a: a["out"])


def without(text: Column, spans: Column, mark: str = "") -> Column:
    """``text`` with every span (structs with start and end in code points, sorted by start; overlapping ones count as
    one) replaced by ``mark``."""
    def piece(c: Column, at: Column) -> Column:
        begin = F.struct(at.alias("at"), F.array().cast("array<string>").alias("out"))

        def step(block: Column):
            def run(a: Column, x: Column) -> Column:
                gap = F.substring(block, (a["at"] - at + 1).cast("int"), (x["start"] - a["at"]).cast("int"))
                grown = F.concat(a["out"], F.array(gap, F.lit(mark)))
                return F.struct(F.greatest(a["at"], x["end"]).alias("at"),
                                F.when(x["start"] < a["at"], a["out"]).otherwise(grown).alias("out"))
            return run

        reach = F.greatest(F.lit(0), F.element_at(c, -1)["start"] - at).cast("int")
        return let(F.substring(text, (at + 1).cast("int"), reach),
                   lambda block: F.aggregate(c, begin, step(block), lambda a: F.array_join(a["out"], "")))

    def whole(parts: Column) -> Column:
        ends = F.transform(parts, lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda a, x: F.greatest(a, x["end"])))

        def joined(ends: Column) -> Column:
            total = F.array_max(ends)
            return F.concat(F.array_join(F.zip_with(parts, before(ends, F.greatest), piece), ""),
                            F.substring(text, (total + 1).cast("int"), F.length(text)))
        return let(ends, joined)

    return F.when(F.size(spans) > 0, let(chunks(spans), whole)).otherwise(text)
