"""Spans of regex matches in code points, from built-in functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:bigint,kind:int,stop:bigint,hit:string,left:string>>"


def none() -> Column:
    return F.array().cast(SPAN)


def spans(text: Column, pattern: str, kind: int, keep: Callable[[Column], Column] | None = None, context: int = 24) -> Column:
    """Leftmost non-overlapping matches of ``pattern`` that pass ``keep``, as structs of type SPAN.

    The pieces between matches and the matches themselves give each match's place by
    adding up their lengths; ``left`` is the end of the piece before the match.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    start = F.struct(F.lit(0).cast("bigint").alias("at"), none().alias("out"))

    def step(acc: Column, pair: Column) -> Column:
        hit, gap = pair["h"], pair["g"]
        at = acc["at"] + F.length(gap)
        stop = at + F.length(hit)
        one = F.array(F.struct(at.cast("bigint").alias("start"), F.lit(kind).alias("kind"), stop.cast("bigint").alias("stop"),
                               hit.alias("hit"), F.right(gap, F.lit(context)).alias("left")))
        good = F.lit(True) if keep is None else F.coalesce(keep(hit), F.lit(False))
        return F.struct(stop.cast("bigint").alias("at"), F.when(hit.isNotNull() & good,
            F.concat(acc["out"], one)).otherwise(acc["out"]).alias("out"))

    pairs = F.arrays_zip(hits.alias("h"), F.slice(gaps, 1, F.size(hits)).alias("g"))
    # no pairs: hits and gaps named for the lambda
    named = F.transform(pairs, lambda p: F.struct(p["h"].alias("h"), p["g"].alias("g")))
    return F.when(text.rlike(pattern), F.aggregate(named, start, step)["out"]).otherwise(none())


def listing(all_spans: Column, names: list[str]) -> Column:
    """``kind:start:end`` by start, then kind in the order of ``names``, comma-joined."""
    label = F.array(*[F.lit(x) for x in names])
    return F.array_join(
        F.transform(F.array_sort(all_spans), lambda s: F.concat_ws(":", F.get(label, s["kind"]), s["start"].cast("string"),
        s["stop"].cast("string"))), ",")


def count(all_spans: Column, kind: int) -> Column:
    return F.size(F.filter(all_spans, lambda s: s["kind"] == kind)).cast("long")
