"""Places of regular-expression matches, with built-in functions only.

``split`` and ``regexp_extract_all`` walk the same leftmost matches that don't overlap, so the lengths of the
pieces between and of the matches give the places, in code points.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = "struct<kind:string,start:bigint,end:bigint,value:string>"
#: Matches whose ends are summed one after the other; longer lists are summed block by block.
BLOCK = 256


@dataclass(frozen=True)
class Rule:
    """``pattern`` never matches an empty string. A match whose text fails ``check`` is dropped and not tried again.
    Texts that don't hold a match of ``hint``, a pattern that is quick to look for, are not searched."""

    kind: str
    pattern: str
    hint: str
    check: object = None
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


def none() -> Column:
    return F.array().cast(f"array<{SPAN}>")


def placed(kind: str, gaps: Column, values: Column) -> Column:
    """The matches with their places, from the text before each and its own."""
    pairs = F.zip_with(gaps, values, lambda gap, value: F.struct(gap.alias("gap"), value.alias("value")))
    count = F.size(values)
    firsts = F.when(count > 0, F.sequence(F.lit(1), count, F.lit(BLOCK))).otherwise(F.array().cast("array<int>"))
    blocks = F.transform(firsts, lambda first: F.slice(pairs, first, BLOCK))
    zero = F.lit(0).cast("bigint")

    def width(pair: Column) -> Column:
        return (F.length(pair["gap"]) + F.length(pair["value"])).cast("bigint")

    widths = F.transform(blocks, lambda block: F.aggregate(block, zero, lambda done, pair: done + width(pair)))
    bases = F.aggregate(widths, F.array(zero), lambda done, more: F.concat(done, F.array(F.element_at(done, -1) + more)))
    bases = F.slice(bases, 1, F.size(blocks))

    def step(state: Column, pair: Column) -> Column:
        begin = state["end"] + F.length(pair["gap"])
        end = begin + F.length(pair["value"])
        span = F.struct(F.lit(kind).alias("kind"), begin.alias("start"), end.alias("end"), pair["value"].alias("value"))
        return F.struct(end.alias("end"), F.concat(state["found"], F.array(span.cast(SPAN))).alias("found"))

    def in_block(block: Column, base: Column) -> Column:
        start = F.struct(base.alias("end"), none().alias("found"))
        return F.aggregate(block, start, step, lambda state: state["found"])

    return F.flatten(F.zip_with(blocks, bases, in_block))


def found(df: DataFrame, text: str, rules: list[Rule], wanted: dict[str, Column] | None = None) -> DataFrame:
    """Adds ``_<kind>`` for each rule: its matches in the text column (never null), as array of SPAN.

    ``wanted``: per kind, whether a row is searched at all.
    """
    pieces, places = {}, {}
    for rule in rules:
        kind = rule.kind
        search = F.col(text).rlike(rule.hint)
        if wanted is not None:
            search = wanted[kind] & search
        pieces[f"_{kind}_values"] = F.when(search, F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)))
        pieces[f"_{kind}_gaps"] = F.when(search, F.split(text, rule.pattern, -1))
    df = df.withColumns(pieces)
    for rule in rules:
        kind = rule.kind
        values, gaps = F.col(f"_{kind}_values"), F.col(f"_{kind}_gaps")
        spans = placed(kind, F.slice(gaps, 1, F.size(values)), values)
        if rule.check is not None:
            check = rule.check
            spans = F.filter(spans, lambda span: check(span["value"]))
        places[f"_{kind}"] = F.when(F.coalesce(F.size(values), F.lit(0)) > 0, spans).otherwise(none())
    return df.withColumns(places).drop(*pieces)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    each = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(each, ",")


def ordered(spans: Column, kinds: list[str], by_start: bool) -> Column:
    """Spans by start, then kind as listed, or the other way round; the values are left out."""
    rank = F.create_map(*[F.lit(x) for pair in zip(kinds, range(len(kinds)), strict=True) for x in pair])

    def keyed(span: Column) -> Column:
        keys = [span["start"].alias("a"), rank[span["kind"]].cast("bigint").alias("b")]
        keys = keys if by_start else [keys[1].alias("a"), keys[0].alias("b")]
        return F.struct(*keys, span["end"].alias("end"), span["kind"].alias("kind"), span["start"].alias("start"))

    return F.array_sort(F.transform(spans, keyed))
