"""Insert-if-new merge with parent lookups and surrogate keys, and upsert."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .dedupe import first_per_key
from .ids import allocate_ids, highest_id

REASON = "_reason"


@dataclass(frozen=True)
class Lookup:
    """Find ``take`` in a parent table by equal columns; a miss rejects the row as ``reason``.

    ``pick`` says which parent row counts when several match: the lowest or the highest value.
    """

    parent: str
    on: Mapping[str, str]  # incoming column -> parent column
    take: str  # parent column
    into: str  # incoming column that receives it
    reason: str
    pick: str = "min"


@dataclass(frozen=True)
class MergeSpec:
    """How incoming records become rows of one star table."""

    table: str
    columns: tuple[str, ...]
    order_by: tuple[str, ...]
    key: tuple[str, ...] = ()  # natural key; empty means every record is new
    lookups: tuple[Lookup, ...] = field(default=())
    id_column: str | None = None


def attach_parents(
    incoming: DataFrame, spec: MergeSpec, parents: Mapping[str, DataFrame]
) -> DataFrame:
    """Fill in parent ids, and set ``_reason`` on rows that miss one.

    The parent side has one row per key, so a join never multiplies rows, and Spark broadcasts it
    when its measured size allows.
    """
    rows = incoming
    if REASON not in rows.columns:
        rows = rows.withColumn(REASON, F.lit(None).cast("string"))
    for lookup in spec.lookups:
        choose = F.max if lookup.pick == "max" else F.min
        found = (
            parents[lookup.parent]
            .groupBy(*[F.col(p).alias(f"_on_{i}") for i, p in lookup.on.items()])
            .agg(choose(lookup.take).alias(lookup.into))
        )
        if lookup.into in rows.columns:
            rows = rows.drop(lookup.into)
        match = [F.col(i) == F.col(f"_on_{i}") for i in lookup.on]
        rows = rows.join(found, match, "left").drop(*[f"_on_{i}" for i in lookup.on])
        missed = F.when(F.col(lookup.into).isNull(), F.lit(lookup.reason))
        rows = rows.withColumn(REASON, F.coalesce(REASON, missed))
    return rows


def merge_new(
    incoming: DataFrame,
    target: DataFrame,
    spec: MergeSpec,
    parents: Mapping[str, DataFrame] | None = None,
    start: Callable[[int], int] | None = None,
) -> DataFrame:
    """The rows to append to ``target``.

    Incoming rows that miss a parent drop out; of several with one natural key the first stays;
    those whose key the target holds drop out; the rest get the next ids in arrival order. A key
    with a null part equals no other key. ``start`` gives the id before the first for a number of
    rows; without it that is the target's highest id.
    """
    rows = attach_parents(incoming, spec, parents or {}).where(F.col(REASON).isNull())
    if spec.key:
        # known keys go first: that join deals rows by key, and the first per key is found there
        rows = rows.join(target.select(*spec.key), list(spec.key), "left_anti")
        rows = first_per_key(rows, spec.key, spec.order_by, null_keys_match=False)
    if spec.id_column:
        rows = allocate_ids(
            rows.drop(spec.id_column),
            spec.id_column,
            spec.order_by,
            start or highest_id(target, spec.id_column),
        )
    kinds = dict(target.dtypes)
    return rows.selectExpr(*[f"CAST(`{c}` AS {kinds[c]}) AS `{c}`" for c in spec.columns])


def merge_upsert(
    incoming: DataFrame,
    target: DataFrame,
    spec: MergeSpec,
    start: Callable[[int], int] | None = None,
) -> DataFrame:
    """What ``target`` becomes: known keys take the values of their last incoming row, new ones are added.

    A known row keeps its id; new rows get the next ids in order of their key's first arrival. Rows
    with a null part in their key are always new. ``incoming`` has its parents attached.
    """
    valid = incoming.where(F.col(REASON).isNull())
    place = F.struct(*[F.col(c) for c in spec.order_by])
    whole = reduce(Column.__and__, [F.col(k).isNotNull() for k in spec.key])
    each = Window.partitionBy(*spec.key, F.when(~whole, place))
    ranked = valid.withColumns(
        {
            "_came": F.min(place).over(each),
            "_last": F.row_number().over(each.orderBy(*[F.desc_nulls_last(c) for c in spec.order_by])),
        }
    ).where("_last = 1")
    kinds = dict(target.dtypes)
    values = [c for c in spec.columns if c not in spec.key and c != spec.id_column]
    updates = ranked.select(
        *[F.col(c).cast(kinds[c]).alias(f"_new_{c}") for c in (*spec.key, *values)], F.lit(True).alias("_hit")
    )
    match = [F.col(k) == F.col(f"_new_{k}") for k in spec.key]
    kept = target.join(updates, match, "left").select(
        *[
            F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
            for c in spec.columns
        ]
    )
    new = ranked.join(target.select(*spec.key), list(spec.key), "left_anti")
    if spec.id_column:
        new = new.drop(spec.id_column)
        new = allocate_ids(
            new, spec.id_column, ["_came"], start or highest_id(target, spec.id_column)
        )
    added = new.selectExpr(*[f"CAST(`{c}` AS {kinds[c]}) AS `{c}`" for c in spec.columns])
    return kept.unionByName(added)


def merge_rejects(
    incoming: DataFrame, spec: MergeSpec, parents: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """The incoming rows that cannot be loaded, each with its ``_reason``."""
    return attach_parents(incoming, spec, parents or {}).where(F.col(REASON).isNotNull())


def merge_audit(
    incoming: DataFrame,
    target: DataFrame,
    spec: MergeSpec,
    parents: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Row counts as (table_name, outcome, row_count): inserted, repeated, exists, or a reason."""
    checked = attach_parents(incoming, spec, parents or {})
    valid = checked.where(F.col(REASON).isNull())
    rejected = checked.where(F.col(REASON).isNotNull()).groupBy(F.col(REASON).alias("outcome"))
    counts = rejected.agg(F.count(F.lit(1)).alias("row_count"))
    if not spec.key:
        loaded = valid.groupBy(F.lit("inserted").alias("outcome"))
        counts = counts.unionByName(loaded.agg(F.count(F.lit(1)).alias("row_count")))
    else:
        complete = F.lit(True)
        for part in spec.key:
            complete = complete & F.col(part).isNotNull()
        # dealt by the key alone, as the join with the known keys is
        per_key = valid.groupBy(*spec.key).agg(F.count(F.lit(1)).alias("_n"))
        known = target.select(*spec.key).distinct().withColumn("_known", F.lit(True))
        totals = (
            per_key.join(known, list(spec.key), "left")
            .groupBy(complete.alias("_complete"), F.coalesce("_known", F.lit(False)).alias("_known"))
            .agg(F.sum("_n").alias("_rows"), F.count(F.lit(1)).alias("_keys"))
        )
        new_keys = F.when(F.col("_complete"), F.col("_keys")).otherwise(F.col("_rows"))
        outcome = F.expr("stack(3, 'exists', _exists, 'inserted', _new, 'repeated', _repeated)")
        split = totals.select(
            F.when(F.col("_known"), F.col("_rows")).otherwise(0).alias("_exists"),
            F.when(~F.col("_known"), new_keys).otherwise(0).alias("_new"),
            F.when(~F.col("_known"), F.col("_rows") - new_keys).otherwise(0).alias("_repeated"),
        ).select(outcome.alias("outcome", "row_count"))
        counts = counts.unionByName(
            split.groupBy("outcome").agg(F.sum("row_count").alias("row_count"))
        )
    return counts.where("row_count > 0").select(
        F.lit(spec.table).alias("table_name"), "outcome", F.col("row_count").cast("long")
    )


def insert_ignore(rows: DataFrame, target: DataFrame, key: str, order_by: list[str]) -> DataFrame:
    """Rows whose primary key the target does not hold, the first of each key."""
    return first_per_key(rows, [key], order_by, null_keys_match=False).join(
        target.select(key), key, "left_anti"
    )


def upsert_by_key(
    target: DataFrame, updates: DataFrame, key: list[str], order_by: str
) -> DataFrame:
    """The target with every updated key replaced by its last update, and new keys added.

    ``order_by`` may have any type that can be ordered, such as an arrival place.
    """
    latest = updates.select(*target.columns, F.col(order_by).alias("_last"))
    kind = latest.schema["_last"].dataType
    both = target.withColumn("_new", F.lit(0)).withColumn("_last", F.lit(None).cast(kind))
    both = both.unionByName(latest.withColumn("_new", F.lit(1)))
    order = [F.desc("_new"), F.col("_last").desc_nulls_last()]
    return first_per_key(both, key, order).select(*target.columns)
