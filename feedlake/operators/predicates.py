"""What a merge predicate lets Spark join by.

A predicate given as one condition is analysed by Spark, as the condition of a join of the two
sides, and its conjuncts are sorted by the sides they read:

* an equality of an expression of the table and one of the source, whatever their names, is a
  pair of join keys;
* a condition on one side only leaves rows of that side without a key;
* bounds from below and above on one expression of the table, by expressions of the source, are a
  band: both sides are cut into bins, and a source row stands in every bin that its bounds touch;
* all else is checked on the pairs.

So a merge by predicate is an equi-join, as one by key columns is. The bins are as wide as the
mean width of the bounds, cut to the range of the table's values, so that all source rows together
stand in at most three times as many bins as there are rows, also where single bounds are open or
very wide.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from feedlake.functions.expressions import all_of

BIN = "_fl_bin"
#: Bins named in one row before they are spread.
_CHUNK = 4096
#: Types whose order a double keeps.
_MEASURABLE = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal", "date", "timestamp")


@dataclass(frozen=True)
class Band:
    """``low`` <= ``value`` <= ``high``, or stricter: SQL over the table, and over the source."""

    value: str
    low: tuple[str, ...]
    high: tuple[str, ...]


@dataclass(frozen=True)
class Match:
    """Keys of both sides by position, as SQL over each side. ``exact``: rows match if and only if
    their keys are equal. ``named``: columns that are equal to their namesakes in every match.
    ``reads``: source columns the predicate depends on."""

    target_keys: tuple[Column, ...]
    source_keys: tuple[Column, ...]
    exact: bool
    band: Band | None
    named: frozenset[str]
    reads: tuple[str, ...]

    @property
    def joins(self) -> bool:
        """Whether there is anything to join by."""
        return bool(self.target_keys) or self.band is not None


def _children(expression) -> list:
    children = expression.children()
    return [children.apply(i) for i in range(children.size())]


def _conjuncts(expression) -> list:
    if expression.nodeName() == "And":
        return [c for child in _children(expression) for c in _conjuncts(child)]
    return [expression]


def analyse(target: DataFrame, source: DataFrame, condition: Column) -> Match:
    """Sort the conjuncts of ``condition``; ``target`` and ``source`` bear their aliases."""
    join = target.join(source, condition)._jdf.queryExecution().analyzed()
    left, right = join.left().outputSet(), join.right().outputSet()

    def side(expression) -> str:
        reads = expression.references()
        if not expression.deterministic() or not expression.resolved():
            return "both"
        if reads.isEmpty():
            return "source"
        return "target" if reads.subsetOf(left) else "source" if reads.subsetOf(right) else "both"

    pairs, named, rest = [], set(), False
    alone: dict[str, list[Column]] = {"target": [], "source": []}
    lows: dict[str, list[str]] = {}
    highs: dict[str, list[str]] = {}

    def bound(value, other, below: bool) -> None:
        kind = value.dataType().simpleString()
        if side(value) == "target" and side(other) == "source" and kind.startswith(_MEASURABLE):
            (lows if below else highs).setdefault(value.sql(), []).append(other.sql())

    root = join.condition()
    for part in _conjuncts(root.get()) if root.isDefined() else []:
        where, kind = side(part), part.nodeName()
        if where != "both":
            alone[where].append(F.expr(part.sql()))
            continue
        if kind == "Between":
            bound(part.input(), part.lower(), True)
            bound(part.input(), part.upper(), False)
            rest = True
            continue
        if kind in ("EqualTo", "EqualNullSafe"):
            a, b = _children(part)
            if side(a) == "source":
                a, b = b, a
            if (side(a), side(b)) == ("target", "source"):
                # Null-safe: in a struct, which is not null itself, nulls are equal.
                wrap = F.struct if kind == "EqualNullSafe" else lambda c: c
                pairs.append((wrap(F.expr(a.sql())), wrap(F.expr(b.sql()))))
                if kind == "EqualTo" and {a.nodeName(), b.nodeName()} == {"AttributeReference"} and a.name().lower() == b.name().lower():
                    named.add(a.name().lower())
                continue
        rest = True
        if kind in ("GreaterThan", "GreaterThanOrEqual", "LessThan", "LessThanOrEqual"):
            a, b = _children(part)
            if kind.startswith("Less"):
                a, b = b, a
            bound(a, b, True)  # a is the greater one
            bound(b, a, False)

    def keyed(keys: list[Column], only: list[Column]) -> tuple[Column, ...]:
        return tuple(F.when(reduce(and_, only), k) for k in keys) if only else tuple(keys)

    bands = [Band(v, tuple(lows[v]), tuple(highs[v])) for v in lows if v in highs]
    reads = root.get().references().intersect(right).toSeq() if root.isDefined() else None
    return Match(
        keyed([a for a, _ in pairs], alone["target"]),
        keyed([b for _, b in pairs], alone["source"]),
        exact=bool(pairs) and not rest,
        band=bands[0] if bands and not pairs else None,
        named=frozenset(named),
        reads=tuple(reads.apply(i).name() for i in range(reads.size())) if reads is not None else (),
    )


def _measure(value: Column) -> Column:
    """A number in the order of the values; NaN comes last, as it does in comparisons."""
    number = value.cast("double")
    return F.when(F.isnan(number), F.lit(float("inf"))).otherwise(number)


def with_bins(target: DataFrame, source: DataFrame, band: Band) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``BIN``; rows whose bounds or value are null, or meet nothing, get none.

    One pass over the value alone and one over the bounds alone measure the bins first. The true
    condition must still be checked on what meets.
    """
    value = _measure(_typed(target, band.value))
    finite = F.when(F.abs(value) < float("inf"), value)
    least, most = target.agg(F.min(finite), F.max(finite)).first()
    if least is None:
        least = most = 0.0

    def within(number: Column) -> Column:
        return F.least(F.greatest(number, F.lit(least)), F.lit(most))

    low = reduce(F.greatest, [_measure(_typed(source, e)) for e in band.low], F.lit(float("-inf")))
    high = reduce(F.least, [_measure(_typed(source, e)) for e in band.high], F.lit(float("inf")))
    # ``greatest`` passes nulls by; a null bound matches nothing.
    known = all_of(F.expr(e).isNotNull() for e in (*band.low, *band.high)) & (low <= high)
    bounded = source.withColumns({"_fl_low": F.when(known, within(low)), "_fl_high": F.when(known, within(high))})
    mean, rows = bounded.agg(F.avg(F.col("_fl_high") - F.col("_fl_low")), F.count("_fl_low")).first()
    width = max(mean or 0.0, (most - least) / max(rows, 1)) or 1.0

    def bin_of(number: Column) -> Column:
        return F.floor((number - F.lit(least)) / F.lit(width)).cast("long")

    first, last = bin_of(F.col("_fl_low")), bin_of(F.col("_fl_high"))
    chunks = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((last - first) / _CHUNK)))
    spread = bounded.where(F.col("_fl_low").isNotNull()).withColumn("_fl_chunk", chunks)
    start = first + F.col("_fl_chunk") * _CHUNK
    spread = spread.withColumn(BIN, F.explode(F.sequence(start, F.least(last, start + (_CHUNK - 1)))))
    return target.withColumn(BIN, bin_of(within(value))), spread.drop("_fl_low", "_fl_high", "_fl_chunk")


def _typed(df: DataFrame, sql: str) -> Column:
    """``sql`` over ``df``; a date as the time it begins."""
    kind = df.select(F.expr(sql)).schema[0].dataType.simpleString()
    value = F.expr(sql)
    if kind in ("date", "timestamp_ntz"):
        value = F.unix_micros(value.cast("timestamp"))
    return value
