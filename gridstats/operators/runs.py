"""Longest runs of flagged rows in a long ordered history."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_FIRST = -(1 << 62)  # before every part
STRETCH_ROWS = 100_000  # rows of a history that one task may put in order


def add_stretches(
    rows: DataFrame, history: str, date: str, budget: int = STRETCH_ROWS
) -> DataFrame:
    """Add ``_part``, which cuts histories of over ``budget`` rows into stretches.

    Most histories are one stretch. A longer one is cut by year, and its years that are still over
    the budget by day. The counts behind this are one row per history and year, added up before they
    are shuffled, and only those of long histories meet the rows again.
    """
    year = F.coalesce(F.year(date), F.lit(0)).alias("_year")
    counts = rows.groupBy(F.col(history).alias("_of"), year).agg(F.count(F.lit(1)).alias("_n"))
    whole = F.sum("_n").over(Window.partitionBy("_of"))
    long = counts.withColumn("_all", whole).where(F.col("_all") > budget)
    long = long.select("_of", F.col("_year").alias("_in"), (F.col("_n") > budget).alias("_daily"))
    met = rows.withColumn("_year", year).join(
        long, F.col(history).eqNullSafe(F.col("_of")) & (F.col("_year") == F.col("_in")), "left"
    )
    day = F.when(F.col("_daily"), F.col(date)).otherwise(F.trunc(date, "year"))
    part = F.when(F.col("_daily").isNull(), 0).otherwise(F.coalesce(F.unix_date(day), F.lit(-(1 << 30))))
    return met.withColumn("_part", part.cast("long")).drop("_of", "_in", "_year", "_daily")


def longest_runs(
    rows: DataFrame,
    history: str,
    member: str,
    order_by: Sequence[str],
    flags: Mapping[str, Column],
    part: Column | None = None,
) -> DataFrame:
    """Per member, the most of its rows in one unbroken run of flagged rows, for every flag.

    Rows are ordered within their history; a row whose flag is false or null ends the run. Several
    members may share a history: a run then spans them all, and each counts its own rows in it.

    A history may be too long for one task, so it is cut into stretches. ``part`` is a whole number
    that never falls along the order and names them: then one shuffle brings a stretch together.
    Without it the rows are range-partitioned by history and order first. Within a stretch, runs that touch neither
    end are finished; only the counts at its two ends travel on, at most one row per stretch,
    member and flag, and are added up across the seams.
    """
    marks = [F.coalesce(test, F.lit(False)).alias(flag) for flag, test in flags.items()]
    if part is None:
        rows = rows.select(history, member, *order_by, *marks)
        cut = rows.repartitionByRange(history, *order_by)
        parts = cut.withColumn("_part", F.spark_partition_id().cast("long"))
    else:
        parts = rows.select(history, member, *order_by, *marks, part.cast("long").alias("_part"))

    stretch = Window.partitionBy("_part", history).orderBy(*order_by)
    so_far = stretch.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = stretch.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def breaks(flag: str, frame) -> Column:
        return F.count(F.when(~F.col(flag), 1)).over(frame)

    per_flag = [
        F.struct(
            F.lit(flag).alias("_flag"),
            F.when(F.col(flag), breaks(flag, so_far)).alias("_run"),
            breaks(flag, whole).alias("_last"),
        )
        for flag in flags
    ]
    runs = (
        parts.select("_part", history, member, F.array(*per_flag).alias("_flags"))
        .select("_part", history, member, F.inline("_flags"))
        .groupBy("_part", history, member, "_flag", "_run", "_last")
        .agg(F.count("_run").alias("_n"))
    )
    at_start, at_end = F.col("_run") == 0, F.col("_run") == F.col("_last")
    ends = runs.groupBy("_part", history, member, "_flag").agg(
        F.sum(F.when(at_start, F.col("_n"))).alias("_head"),
        F.sum(F.when(at_end & ~at_start, F.col("_n"))).alias("_tail"),
        F.max(F.when(~at_start & ~at_end, F.col("_n"))).alias("_inner"),
        (F.max("_last") > 0).alias("_broken"),
    )

    # A seam is named by the last broken stretch before it. The head of a stretch continues the
    # seam before it, the tail opens the seam the stretch itself names. Whether a stretch is broken
    # is the same for all its members, so the window sees one row per stretch and flag.
    earlier = (
        Window.partitionBy(history, "_flag")
        .orderBy("_part")
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    seam = F.coalesce(F.max(F.when(F.col("_broken"), F.col("_part"))).over(earlier), F.lit(_FIRST))
    place = ["_part", history, "_flag"]
    stretches = ends.groupBy(*place).agg(F.max("_broken").alias("_broken"))
    seams = stretches.select(*[F.col(c).alias(f"_at_{c}") for c in place], seam.alias("_before"))
    same = [F.col(c).eqNullSafe(F.col(f"_at_{c}")) for c in place]
    joined = (
        ends.join(seams, same)
        .select(
            member,
            "_flag",
            "_inner",
            F.inline(
                F.array(
                    F.struct(F.col("_before").alias("_seam"), F.col("_head").alias("_n")),
                    F.struct(F.col("_part").alias("_seam"), F.col("_tail").alias("_n")),
                )
            ),
        )
        .groupBy(member, "_flag", "_seam")
        .agg(F.max("_inner").alias("_inner"), F.sum("_n").alias("_n"))
    )
    return joined.groupBy(member).agg(
        *[
            F.coalesce(F.max(F.when(F.col("_flag") == flag, F.greatest("_inner", "_n"))), F.lit(0))
            .cast("long")
            .alias(flag)
            for flag in flags
        ]
    )
