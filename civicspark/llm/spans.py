"""Positions of pattern matches, with SQL functions only (shared by operators 4 and 5)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A span: kind's number, start and end in code points (end exclusive), matched text, kind.
SPAN = "array<struct<start:int,kind_no:int,end:int,kind:string,value:string>>"


def no_spans() -> Column:
    return F.array().cast(SPAN)


#: Items folded together, and code points of a block.  A fold copies its output at each item, so
#: it runs over chunks and keeps finished ones aside; a position is looked up within its block.
CHUNK, BLOCK = 256, 4096


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def chunks(items: Column) -> Column:
    """The items in arrays of at most ``CHUNK``; one empty array if there are none."""
    last = F.floor(F.greatest(F.size(items) - 1, F.lit(0)) / CHUNK).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda j: F.slice(items, j * CHUNK + 1, F.lit(CHUNK)))


def running(items: Column, zero: Column, step: Callable[[Column, Column], tuple[Column, Column]], kind: str) -> Column:
    """One output of type ``kind`` for each item, in order: ``step`` gives the next state and the output."""
    none, nested = F.array().cast(f"array<{kind}>"), F.array().cast(f"array<array<{kind}>>")

    def one(state: Column, item: Column) -> Column:
        after, output = step(state["s"], item)
        return F.struct(after.alias("s"), F.concat(state["o"], F.array(output.cast(kind))).alias("o"))

    def part(state: Column, chunk: Column) -> Column:
        done = F.aggregate(chunk, F.struct(state["s"].alias("s"), none.alias("o")), one)
        return let(done, lambda d: F.struct(d["s"].alias("s"), F.concat(state["o"], F.array(d["o"])).alias("o")))

    whole = lambda x: F.aggregate(chunks(x), F.struct(zero.alias("s"), nested.alias("o")), part, lambda s: F.flatten(s["o"]))
    return let(items, whole)


def blocks(text: Column) -> Column:
    """The text cut into blocks of ``BLOCK`` code points."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), 0)


def piece(parts: Column, start: Column, end: Column) -> Column:
    """The code points from ``start`` to ``end`` (exclusive) of a text cut by ``blocks``."""
    first = F.floor(start / BLOCK).cast("int")
    last = F.floor(F.greatest(end - 1, start) / BLOCK).cast("int")
    near = F.array_join(F.slice(parts, first + 1, last - first + 1), "")
    return F.when(end > start, F.substring(near, start - first * BLOCK + 1, end - start)).otherwise("")


def rest(parts: Column, start: Column) -> Column:
    """The code points from ``start`` on of a text cut by ``blocks``."""
    first = F.floor(start / BLOCK).cast("int")
    return F.concat(F.substring(F.coalesce(F.get(parts, first), F.lit("")), start - first * BLOCK + 1, F.lit(BLOCK)),
                    F.array_join(F.slice(parts, first + 2, F.greatest(F.size(parts) - first - 1, F.lit(0))), ""))


def matches(text: Column, pattern: str, kind: str, kind_no: int, possible: Column | None = None) -> Column:
    """Leftmost non-overlapping matches as spans; empty for null text.

    The text between matches and the matches themselves alternate, so their lengths add up to
    the positions.  ``possible`` is a cheaper test that is true wherever a match exists.
    """
    hits, gaps = F.regexp_extract_all(text, F.lit(pattern), 0), F.split(text, pattern, -1)

    def add(at: Column, pair: Column) -> tuple[Column, Column]:
        start = at + F.length(pair["gap"])
        end = start + F.length(pair["hit"])
        return end, F.struct(start.alias("start"), F.lit(kind_no).alias("kind_no"), end.alias("end"),
                             F.lit(kind).alias("kind"), pair["hit"].alias("value"))

    # The last gap has no match behind it and is dropped.
    pairs = F.transform(
        F.filter(F.arrays_zip(gaps.alias("gap"), hits.alias("hit")), lambda x: x["hit"].isNotNull()),
        lambda x: F.struct(x["gap"].alias("gap"), x["hit"].alias("hit")))
    spans = running(pairs, F.lit(0), add, SPAN[len("array<"):-1])
    found = text.rlike(pattern) if possible is None else possible & text.rlike(pattern)
    return F.when(found, spans).otherwise(no_spans())


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined in the given order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def apart_from(spans: Column, others: Column) -> Column:
    """The spans that overlap none of the others, by start.  ``spans`` do not overlap one another.

    Both are sorted and merged: a span waits until a later one of its own comes, and is given up
    if one of the others reaches into it, from before or from after.
    """
    kind = SPAN[len("array<"):-1]
    nothing = F.lit(None).cast(kind)
    mark = lambda side: lambda s: F.struct(s["start"].alias("at"), F.lit(side).alias("side"), s.alias("span"))
    end = F.struct(F.lit(2**31 - 1).alias("at"), F.lit(2).alias("side"), nothing.alias("span"))
    merged = F.sort_array(F.concat(F.transform(others.cast(SPAN), mark(0)), F.transform(spans.cast(SPAN), mark(1)), F.array(end)))

    def step(state: Column, item: Column) -> tuple[Column, Column]:
        other, waiting = item["side"] == 0, state["waiting"]
        reach = F.when(other, F.greatest(state["reach"], item["span"]["end"])).otherwise(state["reach"])
        still = F.when(waiting["end"] > item["at"], nothing).otherwise(waiting)  # the other begins inside
        fresh = F.when((item["side"] == 1) & (state["reach"] <= item["at"]), item["span"]).otherwise(nothing)
        return F.struct(reach.alias("reach"), F.when(other, still).otherwise(fresh).alias("waiting")), F.when(other, nothing).otherwise(waiting)

    zero = F.struct(F.lit(0).alias("reach"), nothing.alias("waiting"))
    apart = F.filter(running(merged, zero, step, kind), lambda s: s.isNotNull())
    return F.when((F.size(spans) == 0) | (F.size(others) == 0), spans).otherwise(apart)
