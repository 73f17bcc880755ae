"""N-way left-join enrichment declared as metadata."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.operators.cdc import END_AT, START_AT, current


@dataclass(frozen=True)
class JoinSpec:
    """One lookup to join on the left-joined chain.

    ``on`` and ``where`` are SQL conditions that may name any earlier alias.
    Whether the lookup is broadcast is Spark's choice by its size in bytes; nothing
    is read to build the join. Batch joins of two large sides have AQE's skew
    handling. Streams have no AQE, so a large lookup on a hot key may be given
    ``salts`` > 1: the key's rows are then spread over that many tasks, each meeting
    its own copy of the lookup row. With ``hot_on``, the key as an expression of the base
    and of the lookup, only the keys in ``hot`` (as text) are spread and only their lookup
    rows copied.
    """

    table: DataFrame | str
    alias: str
    on: str
    select: Sequence[str] = field(default_factory=tuple)
    where: str = ""
    salts: int = 1
    hot_on: tuple[str, str] | None = None
    hot: Sequence[str] = ()


def _lookup(spark: SparkSession, spec: JoinSpec) -> DataFrame:
    return spark.table(spec.table) if isinstance(spec.table, str) else spec.table


def _hashable(df: DataFrame) -> list[str]:
    return [n for n, t in df.dtypes if "map<" not in t and "variant" not in t]


def _conjunction(predicates: Sequence[str]):
    return reduce(lambda a, b: a & b, (F.expr(p) for p in predicates))


def enrich(
    base: DataFrame,
    base_alias: str,
    base_select: Sequence[str],
    specs: Sequence[JoinSpec],
    where: str = "",
) -> DataFrame:
    """Left-join ``base`` with every spec in order and project the listed expressions.

    Works on batch and streaming bases alike. A row without a match keeps null
    lookup columns; duplicate lookup keys multiply rows. All non-empty predicates
    are ANDed and applied after the joins, so one on a lookup column also removes
    the unmatched rows.
    """
    joined = base.alias(base_alias)
    for spec in specs:
        lookup = _lookup(base.sparkSession, spec)
        condition = F.expr(spec.on)
        if spec.salts > 1 and (spec.hot or spec.hot_on is None):
            salt = f"__salt_{spec.alias}"
            # From the row itself, so that a recomputed task deals it out alike.
            row = F.xxhash64(*(F.col(f"{base_alias}.`{c}`") for c in _hashable(base)))
            dealt, copies = F.pmod(row, F.lit(spec.salts)).cast("int"), F.sequence(F.lit(0), F.lit(spec.salts - 1))
            if spec.hot_on is not None:
                hot = [F.expr(key).cast("string").isin(*spec.hot) for key in spec.hot_on]
                dealt = F.when(hot[0], dealt).otherwise(F.lit(0))
                copies = F.when(hot[1], copies).otherwise(F.array(F.lit(0)))
            joined = joined.withColumn(salt, dealt)
            lookup = lookup.alias(spec.alias).withColumn("__salt", F.explode(copies))
            condition = condition & (F.col(salt) == F.col(f"{spec.alias}.__salt"))
        joined = joined.join(lookup.alias(spec.alias), condition, "left")

    predicates = [p for p in (where, *(s.where for s in specs)) if p.strip()]
    if predicates:
        joined = joined.where(_conjunction(predicates))
    return joined.selectExpr(*base_select, *(e for s in specs for e in s.select))


@dataclass(frozen=True)
class Dimension:
    """A dimension to read back: its rows, the column it hangs on, and its own key if named otherwise."""

    rows: DataFrame
    on: str
    key: str | None = None


def read_back(fact: DataFrame, dimensions: Sequence[Dimension]) -> DataFrame:
    """A fact with the columns of its dimensions, each joined from the left in the given order.

    A dimension may hang on a column of the fact or of a dimension before it. Of one that
    keeps its history the current versions count. Keys appear once, under the name they hang
    on. Joins carry no hint: Spark broadcasts dimensions that prove small and splits
    skewed partitions of those that do not.
    """
    joined = fact
    for dimension in dimensions:
        rows = dimension.rows
        if END_AT in rows.columns:
            rows = current(rows).drop(START_AT, END_AT)
        if dimension.key is not None:
            rows = rows.withColumnRenamed(dimension.key, dimension.on)
        joined = joined.join(rows, dimension.on, "left")
    return joined.select(*fact.columns, *(c for c in joined.columns if c not in fact.columns))


def label_to_id(
    df: DataFrame,
    label: str,
    lookup: DataFrame,
    lookup_label: str,
    lookup_id: str,
    output: str,
    default: int | None = None,
) -> DataFrame:
    """Replace a label by its lookup id; null or unknown labels take ``default``."""
    found = f"ids.{lookup_id}"
    picked = found if default is None else f"coalesce({found}, {default}L)"
    kept = [f"base.`{c}`" for c in df.columns if c != output]
    spec = JoinSpec(
        lookup.select(lookup_label, lookup_id),
        "ids",
        f"base.`{label}` = ids.`{lookup_label}`",
        [f"{picked} AS {output}"],
    )
    return enrich(df, "base", kept, [spec])
