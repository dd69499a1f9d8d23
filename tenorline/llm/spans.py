"""Positions of pattern matches as column expressions.

A span is a struct (kind, start, end, value): code points, end exclusive.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F

SPANS = "array<struct<kind:string,start:bigint,end:bigint,value:string>>"


def no_spans() -> Column:
    return F.expr(f"cast(array() as {SPANS})")


def matches(text: Column, pattern: str, kind: str, worth: Column, accept: Callable[[Column], Column]) -> Column:
    """Leftmost non-overlapping matches of ``pattern`` that ``accept``, in order.

    ``worth`` is a cheap test that every text with a match passes; only those are taken apart,
    into the matches and the gaps that a split at them leaves, whose lengths add up to
    positions. The work for n matches grows with n * sqrt(n). ``pattern`` never matches nothing
    and has no capturing groups. Write inner repetitions of groups as possessive ones: these run
    in a loop, others recurse and overflow the stack on long runs.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits))
    pairs = F.zip_with(gaps, hits, lambda g, h: F.struct(g.alias("gap"), h.alias("hit"), (F.length(g) + F.length(h)).alias("moved")))

    def spans(run: Column, begin: Column) -> Column:
        """Of a run of pairs that begins at a position."""
        start = F.struct(begin.alias("at"), no_spans().alias("spans"))

        def step(s: Column, x: Column) -> Column:
            first, end = s["at"] + F.length(x["gap"]), s["at"] + x["moved"]
            span = F.struct(F.lit(kind).alias("kind"), first.alias("start"), end.alias("end"), x["hit"].alias("value"))
            return F.struct(end.alias("at"), F.when(accept(x["hit"]), F.concat(s["spans"], F.array(span)))
                            .otherwise(s["spans"]).alias("spans"))

        return F.aggregate(run, start, step, lambda s: s["spans"])

    def in_runs(pairs: Column) -> Column:
        # Arrays that grow are copied at each step, so n pairs are dealt to about sqrt(n) runs of sqrt(n).
        width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(pairs))).cast("int"))
        runs = F.transform(F.sequence(F.lit(0), F.size(pairs) - 1, width), lambda k: F.slice(pairs, k + 1, width))
        return _let(runs, lambda runs: F.flatten(F.zip_with(runs, _starts(runs), spans)))

    found = _let(pairs, lambda pairs: F.when(F.size(pairs) > 0, in_runs(pairs)).otherwise(no_spans()))
    return F.when(worth, found).otherwise(no_spans())


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _starts(runs: Column) -> Column:
    """Where each run of pairs begins: the moves of all runs before."""
    moved = F.transform(runs, lambda run: F.aggregate(run, F.lit(0).cast("long"), lambda s, x: s + x["moved"]))
    return F.aggregate(moved, F.struct(F.lit(0).cast("long").alias("at"), F.expr("cast(array() as array<bigint>)").alias("starts")),
                       lambda s, m: F.struct((s["at"] + m).alias("at"), F.concat(s["starts"], F.array(s["at"])).alias("starts")),
                       lambda s: s["starts"])


def told(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def by_start(spans: Column, kinds: Sequence[str]) -> Column:
    """Sorted by start, then by the kinds' order as listed, then by end."""
    keyed = F.transform(spans, lambda s: F.struct(
        s["start"].alias("at"), F.array_position(F.lit(list(kinds)), s["kind"]).alias("rank"), s["end"].alias("until"),
        s.alias("span")))
    return F.transform(F.array_sort(keyed), lambda x: x["span"])


def outside(spans: Column, others: Column) -> Column:
    """The spans that overlap none of ``others``."""
    return F.filter(spans, lambda s: ~F.exists(others, lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"])))


def replaced(text: Column, spans: Column, mark: Callable[[Column], Column]) -> Column:
    """``text`` with each span exchanged for ``mark(kind)``; of overlapping spans the first
    (by start, then the longest) gives the mark, and all that they cover goes."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), (-s["end"]).alias("low"), s["end"].alias("end"), s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.expr("cast(array() as array<string>)").alias("parts"))

    def step(s: Column, x: Column) -> Column:
        fresh = F.concat(s["parts"], F.array(
            F.substring(text, (s["at"] + 1).cast("int"), (x["start"] - s["at"]).cast("int")), mark(x["kind"])))
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"),
                        F.when(x["start"] >= s["at"], fresh).otherwise(s["parts"]).alias("parts"))

    whole = F.aggregate(ordered, start, step, lambda s: F.concat(
        F.array_join(s["parts"], ""), F.substring(text, (s["at"] + 1).cast("int"), F.lit(2**31 - 1))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)
