"""Keyed de-duplication and slowly changing dimensions.

Every operator reduces before it shuffles: a key that holds a third of the rows
leaves each map task as one row, so no task ever sees the whole of a hot group.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Literal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Keep = Literal["first", "latest"]

START_AT = "__START_AT"
END_AT = "__END_AT"


@dataclass(frozen=True)
class CdcSpec:
    """A keyed target described as data.

    ``columns`` is what the target shows; ``sequence_by`` and ``tie_break`` are
    read besides them. ``collapse`` says its rows repeat heavily in the source,
    as a dimension's do in a wide table; they are then merged by hash
    aggregation before any ordering takes place.
    """

    name: str
    columns: Sequence[str]
    keys: Sequence[str]
    sequence_by: str
    scd_type: Literal[1, 2] = 1
    keep: Keep = "latest"
    collapse: bool = False
    tie_break: Sequence[str] | None = None

    @property
    def source_columns(self) -> list[str]:
        """Columns to read: the shown ones and those that order them."""
        ordering = (self.sequence_by, *(self.tie_break or ()))
        return list(dict.fromkeys([*self.columns, *self.keys, *ordering]))


def all_present(columns: Sequence[str]) -> Column:
    """None of the columns is null."""
    return reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in columns))


def sequenced(df: DataFrame, keys: Sequence[str], sequence_by: str) -> DataFrame:
    """Rows that can be placed in a history: key and sequence are present."""
    return df.where(all_present([*keys, sequence_by]))


def unsequenced(df: DataFrame, keys: Sequence[str], sequence_by: str) -> DataFrame:
    """The complement of :func:`sequenced`, for reporting."""
    return df.where(~all_present([*keys, sequence_by]))


def _total_order(
    df: DataFrame, keys: Sequence[str], leading: Sequence[str], ties: Sequence[str] | None
) -> list[str]:
    """Ordering columns, extended by all the rest so that no two unequal rows tie."""
    rest = [c for c in df.columns if c not in keys]
    ordered = dict.fromkeys([*leading, *(ties or ()), *rest])
    return [c for c in ordered if c not in keys]


def _one_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: Keep
) -> DataFrame:
    """The first or last row per key under ``order``, nulls last either way.

    A struct compares field by field, so one min/max carries both the order and
    the payload and combines on the map side.
    """
    out = df.columns
    if not order:
        return df.select(*keys).distinct()
    if keep == "latest":
        picked = F.max(F.struct(*order))
    else:
        # Ascending order puts nulls first; a leading flag moves them to the end.
        fields = [
            f for i, c in enumerate(order) for f in (F.col(c).isNull().alias(f"__null{i}"), F.col(c))
        ]
        picked = F.min(F.struct(*fields))
    picked_rows = df.groupBy(*keys).agg(picked.alias("__row"))
    return picked_rows.select(*(c if c in keys else F.col(f"__row.`{c}`").alias(c) for c in out))


def dedup_first(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], keep: Keep = "first"
) -> DataFrame:
    """One row per key: the first (or last) under a stated order.

    ``order_by`` is completed with the remaining columns, so the result does not
    depend on how the input is partitioned. Null keys form a group of their own.
    """
    return _one_per_key(df, keys, _total_order(df, keys, order_by, None), keep)


def collapse_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: Keep) -> DataFrame:
    """Merge rows equal in all but the leading order column, keeping its best value.

    The rest are grouping columns and the leading one is a plain min or max, which
    Spark runs as a map-side hash aggregation instead of a sort.
    """
    if not order:
        return df.select(*keys).distinct()
    lead = order[0]
    pick = F.max if keep == "latest" else F.min
    same = [c for c in df.columns if c != lead]
    return df.groupBy(*same).agg(pick(lead).alias(lead)).select(*df.columns)


def scd1(
    df: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    tie_break: Sequence[str] | None = None,
    keep: Keep = "latest",
    collapse: bool = False,
) -> DataFrame:
    """Type 1: one row per key, picked by sequence and not by arrival.

    Equal sequences are settled by ``tie_break`` and then by the remaining
    columns, descending with nulls last (ascending for ``keep="first"``).
    Rows without key or sequence are left out; see :func:`unsequenced`.
    """
    rows = sequenced(df, keys, sequence_by)
    order = _total_order(rows, keys, [sequence_by], tie_break)
    if collapse:
        rows = collapse_rows(rows, keys, order, keep)
    return _one_per_key(rows, keys, order, keep)


def versions(
    df: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    tie_break: Sequence[str] | None = None,
    collapse: bool = False,
) -> DataFrame:
    """One row per (key, sequence), the unit a type 2 history is made of."""
    rows = sequenced(df, keys, sequence_by)
    identity = list(dict.fromkeys([*keys, sequence_by]))
    if collapse:
        # Dealt out in between, or the optimizer drops the distinct: a maximum is the same without it.
        rows = rows.distinct().repartition(*identity)
    return _one_per_key(rows, identity, _total_order(rows, identity, [], tie_break), "latest")


SLICE = "__slice"
SLICE_BITS = 12
SLICE_PREFIX = 13


def slice_of(df: DataFrame, sequence_by: str) -> Column:
    """A coarser value of the sequence, which cuts a long history into consecutive slices.

    Times go by the hour, dates by the month, whole numbers by their bits above ``SLICE_BITS``, other
    numbers by their whole part, and text by its first ``SLICE_PREFIX`` characters (the
    hour of a time in ISO format). It never falls as the sequence rises and depends on nothing else.
    """
    column, kind = F.col(sequence_by), dict(df.dtypes)[sequence_by]
    if kind in ("timestamp", "timestamp_ntz"):
        return F.date_trunc("hour", column)
    if kind == "date":
        return F.trunc(column, "month")
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return F.shiftright(column.cast("bigint"), SLICE_BITS)
    if kind == "string":
        return F.substring(column, 1, SLICE_PREFIX)
    if kind in ("float", "double"):
        return F.floor(F.greatest(F.least(column.cast("double"), F.lit(2.0**52)), F.lit(-(2.0**52))))
    return F.floor(column) if kind.startswith("decimal") else F.lit(0)


def _history(
    df: DataFrame, keys: Sequence[str], sequence_by: str, tie_break: Sequence[str] | None, collapse: bool
) -> DataFrame:
    """Versions and their end, with no key's history in one task.

    Rows are dealt out once, by key and slice of the sequence; copies merge and a version's
    end is found where they then are. Only the last version of each slice travels on, with
    the slice's first sequence, to meet those of the key's other slices: its end is the
    first sequence of the next one.
    """
    rows = sequenced(df, keys, sequence_by)
    if collapse:
        rows = rows.distinct()
    dealt = rows.withColumn(SLICE, slice_of(rows, sequence_by)).repartition(*keys, SLICE)
    identity = list(dict.fromkeys([*keys, SLICE, sequence_by]))
    merged = _one_per_key(dealt, identity, _total_order(dealt, identity, [], tie_break), "latest")
    within = Window.partitionBy(*keys, SLICE).orderBy(sequence_by)
    marked = merged.withColumn(END_AT, F.lead(sequence_by).over(within)).withColumn(
        "__opens", F.first(sequence_by).over(within)
    )
    inner = marked.where(F.col(END_AT).isNotNull())
    across = Window.partitionBy(*keys).orderBy(sequence_by)
    last = marked.where(F.col(END_AT).isNull()).withColumn(END_AT, F.lead("__opens").over(across))
    return inner.unionByName(last).drop(SLICE, "__opens")


def scd2(
    df: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    tie_break: Sequence[str] | None = None,
    collapse: bool = False,
) -> DataFrame:
    """Type 2: every version with ``__START_AT`` and ``__END_AT`` (null while current).

    There is one version per distinct (key, sequence). All keys, long or short, take the
    same path, and nothing is read to choose it.
    """
    dated = _history(df, keys, sequence_by, tie_break, collapse)
    return dated.withColumn(START_AT, F.col(sequence_by)).select(*df.columns, START_AT, END_AT)


def splice(
    stored: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    tie_break: Sequence[str] | None = None,
    collapse: bool = False,
) -> DataFrame:
    """A stored type 2 history, with ``__END_AT``, after more changes in whatever order they come.

    Of a key only the versions that were open at some time between its earliest and its
    latest change are ended anew; those closed before or started after stay as they
    are, and so do all versions of other keys. Changes already stored change nothing.
    """
    columns = [c for c in stored.columns if c != END_AT]
    new = versions(changes.select(*columns), keys, sequence_by, tie_break, collapse)
    bounds = new.groupBy(*keys).agg(F.min(sequence_by).alias("__from"), F.max(sequence_by).alias("__to"))
    placed = stored.join(bounds, list(keys), "left")
    open_then = F.col(END_AT).isNull() | (F.col(END_AT) > F.col("__from"))
    hit = F.coalesce((F.col(sequence_by) <= F.col("__to")) & open_then, F.lit(False))
    untouched = placed.where(~hit)
    following = untouched.where(F.col(sequence_by) > F.col("__to")).groupBy(*keys).agg(
        F.min(sequence_by).alias("__following")
    )
    again = placed.where(hit).select(*columns).unionByName(new)
    ended = _history(again, keys, sequence_by, tie_break, False).join(following, list(keys), "left")
    repaired = ended.withColumn(END_AT, F.coalesce(END_AT, "__following"))
    shown = [*columns, END_AT]
    return untouched.select(*shown).unionByName(repaired.select(*shown))


def current(history: DataFrame) -> DataFrame:
    """Versions of a type 2 history that are still open."""
    return history.where(F.col(END_AT).isNull())


def apply_changes(
    source: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    scd_type: Literal[1, 2] = 1,
    tie_break: Sequence[str] | None = None,
    keep: Keep = "latest",
    collapse: bool = False,
) -> DataFrame:
    """The state a keyed target reaches after all changes in ``source``."""
    if scd_type == 1:
        return scd1(source, keys, sequence_by, tie_break, keep, collapse)
    if scd_type == 2:
        return scd2(source, keys, sequence_by, tie_break, collapse)
    raise ValueError(f"scd_type must be 1 or 2, not {scd_type!r}")


def build_target(source: DataFrame, spec: CdcSpec) -> DataFrame:
    """Apply a spec to a wide source, reading only the columns it names."""
    rows = source.select(*spec.source_columns)
    state = apply_changes(
        rows, spec.keys, spec.sequence_by, spec.scd_type, spec.tie_break, spec.keep, spec.collapse
    )
    extra = [START_AT, END_AT] if spec.scd_type == 2 else []
    return state.select(*spec.columns, *extra)
