"""Returns within a horizon after a visit ends, from running counts instead of an interval self-join.

Every visit puts points on its patient's time line: its start, its end, and its end plus the horizon. With the number
of starts up to each point known, the returns of a visit are the difference of two such numbers, so no pair of visits
is ever formed. One shuffle by patient (and slice, for a patient with very many visits) yields all measures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlake.functions.columns import MICROS_PER_DAY
from wardlake.operators.skew import slice_of

START, END, LIMIT = "start", "end", "limit"


def _running(points: DataFrame, hot: list, slice_micros: int) -> DataFrame:
    """Running measures at each point of (patient, at, is_start, is_end).

    starts_upto: starts at or before the point; starts_at, ends_at: starts and ends at the very instant;
    next_start: first start after it; last_end: last end before it.
    """
    line_keys = ["patient"]
    if hot:
        within = F.floor(F.col("at") / slice_micros).cast("bigint")
        points, line_keys = points.withColumn("_slice", slice_of(F.col("patient"), hot, within)), ["patient", "_slice"]
    line = Window.partitionBy(*line_keys).orderBy("at")
    upto = line.rangeBetween(Window.unboundedPreceding, 0)
    before = line.rangeBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*line_keys).orderBy(F.desc("at")).rangeBetween(Window.unboundedPreceding, -1)
    starts, ends = F.col("is_start").cast("long"), F.col("is_end").cast("long")
    start_at, end_at = F.when(F.col("is_start"), F.col("at")), F.when(F.col("is_end"), F.col("at"))
    none = F.lit(0).cast("long")
    out = points.withColumns(
        {
            "starts_upto": F.sum(starts).over(upto),
            "starts_at": F.sum(starts).over(upto) - F.coalesce(F.sum(starts).over(before), none),
            "ends_at": F.sum(ends).over(upto) - F.coalesce(F.sum(ends).over(before), none),
            "last_end": F.max(end_at).over(before),
            "next_start": F.min(start_at).over(after),
        }
    )
    if not hot:
        return out

    per_slice = (
        points.where(F.col("_slice").isNotNull())
        .groupBy("patient", "_slice")
        .agg(F.sum(starts).alias("n"), F.max(end_at).alias("e"), F.min(start_at).alias("s"))
    )
    slices = Window.partitionBy("patient").orderBy("_slice")
    earlier = slices.rowsBetween(Window.unboundedPreceding, -1)
    later = (
        Window.partitionBy("patient").orderBy(F.desc("_slice")).rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = per_slice.select(
        F.col("patient").alias("_patient"),
        F.col("_slice").alias("_at"),
        F.coalesce(F.sum("n").over(earlier), none).alias("_starts"),
        F.max("e").over(earlier).alias("_end"),
        F.min("s").over(later).alias("_start"),
    )
    return (
        out.join(carried, (F.col("patient") == F.col("_patient")) & (F.col("_slice") == F.col("_at")), "left")
        .withColumn("starts_upto", F.col("starts_upto") + F.coalesce("_starts", none))
        .withColumn("last_end", F.coalesce("last_end", "_end"))
        .withColumn("next_start", F.coalesce("next_start", "_start"))
        .drop("_slice", "_patient", "_at", "_starts", "_end", "_start")
    )


def _timeline(visits: DataFrame, horizon_micros: int, hot: list, carry: tuple[str, ...], slice_micros: int) -> DataFrame:
    """The points of all visits with their running measures."""
    ended = F.col("end_at").isNotNull() & F.col("is_index")
    marks = [
        (START, F.col("start_at"), F.col("start_at").isNotNull(), F.col("is_return"), F.lit(False)),
        (END, F.col("end_at"), ended, F.lit(False), F.lit(True)),
        (LIMIT, F.col("end_at") + horizon_micros, ended, F.lit(False), F.lit(False)),
    ]
    structs = F.array(
        *[
            F.when(
                used,
                F.struct(
                    F.lit(kind).alias("kind"), at.alias("at"), is_start.alias("is_start"), is_end.alias("is_end")
                ),
            )
            for kind, at, used, is_start, is_end in marks
        ]
    )
    kept = ["patient", "visit", "start_at", "end_at", "is_return", *carry]
    points = visits.select(*kept, F.inline(F.array_compact(structs)))
    return _running(points, hot, slice_micros)


def total_returns(
    visits: DataFrame, horizon_micros: int, hot: list, by: str, slice_micros: int = MICROS_PER_DAY
) -> DataFrame:
    """Ended index visits and their returns per value of ``by``, a visit itself among its returns if it qualifies.

    Sums of differences are differences of sums, so the points are added up directly, without a row per visit.
    """
    timeline = _timeline(visits, horizon_micros, hot, (by,), slice_micros)
    sign = F.when(F.col("kind") == LIMIT, F.col("starts_upto")).when(F.col("kind") == END, -F.col("starts_upto"))
    return timeline.groupBy(by).agg(
        F.count_if(F.col("kind") == END).alias("visits"), F.coalesce(F.sum(sign), F.lit(0)).alias("returns")
    ).where(F.col("visits") > 0)


def returns_within(
    visits: DataFrame,
    horizon_micros: int,
    hot: list,
    exclude_self: bool = True,
    carry: tuple[str, ...] = (),
    slice_micros: int = MICROS_PER_DAY,
) -> DataFrame:
    """Per ended index visit: returns in (end, end + horizon], the first of them, and whether it is itself a return.

    ``visits`` has patient, visit, start_at, end_at (microseconds, end may be NULL), is_index, is_return. Starts count
    when ``is_return``; ends count when ``is_index``. With ``exclude_self`` a visit whose end lies before its own start
    is not its own return. ``hot`` lists the patients to cut into slices, ``carry`` the visit columns to keep.
    Output: patient, visit, end_at, carried columns, returns, first_return (microseconds), is_return_visit.
    """
    timeline = _timeline(visits, horizon_micros, hot, carry, slice_micros)

    def at(kind: str, value: str) -> Column:
        return F.max(F.when(F.col("kind") == kind, F.col(value)))

    # The windows have put a patient's rows together; grouping by patient as well needs no second shuffle.
    per_visit = timeline.groupBy("patient", "visit").agg(
        F.max("start_at").alias("start_at"),
        at(END, "end_at").alias("end_at"),
        F.max("is_return").alias("is_return"),
        *[F.max(c).alias(c) for c in carry],
        (at(LIMIT, "starts_upto") - at(END, "starts_upto")).alias("returns"),
        at(END, "next_start").alias("first_return"),
        at(START, "last_end").alias("last_end"),
        at(START, "starts_at").alias("starts_at"),
        at(START, "next_start").alias("second_return"),
        at(END, "ends_at").alias("ends_at"),
        at(END, "last_end").alias("earlier_end"),
    ).where(F.col("end_at").isNotNull())

    limit = F.col("end_at") + horizon_micros
    returns, first, last_end = F.col("returns"), F.col("first_return"), F.col("last_end")
    if exclude_self:
        own_start = F.col("is_return") & (F.col("start_at") > F.col("end_at")) & (F.col("start_at") <= limit)
        returns = returns - F.coalesce(own_start.cast("int"), F.lit(0))
        alone = (first == F.col("start_at")) & F.col("is_return") & (F.col("starts_at") == 1)
        first = F.when(alone, F.col("second_return")).otherwise(first)
        own_end = (last_end == F.col("end_at")) & (F.col("ends_at") == 1)
        last_end = F.when(own_end, F.col("earlier_end")).otherwise(last_end)
    return per_visit.select(
        "patient",
        "visit",
        "end_at",
        *carry,
        returns.alias("returns"),
        F.when(returns > 0, first).alias("first_return"),
        F.coalesce(F.col("start_at") <= last_end + horizon_micros, F.lit(False)).alias("is_return_visit"),
    )


def days_over_returns(visits: DataFrame, measured: DataFrame, horizon_days: int, hot: list) -> DataFrame:
    """Sum over all returns of a visit of the whole days since its end: visit, day_sum.

    One return needs only the first start. For more, the sum of whole days is the sum over k = 1 .. horizon of the
    returns at least k days after the end, again differences of running counts.
    """
    single = measured.where(F.col("returns") == 1).select(
        "visit", F.floor((F.col("first_return") - F.col("end_at")) / MICROS_PER_DAY).alias("day_sum")
    )
    several = measured.where(F.col("returns") > 1).select("patient", "visit", "end_at")
    starts = (
        visits.where("is_return AND start_at IS NOT NULL")
        .join(several.select("patient").distinct(), "patient", "left_semi")
        .select("patient", F.lit(None).cast("bigint").alias("visit"), F.col("start_at").alias("at"), F.lit(0).alias("k"))
    )
    marks = several.select(
        "patient", "visit", "end_at", F.explode(F.sequence(F.lit(0), F.lit(horizon_days))).alias("k")
    ).select(
        "patient",
        "visit",
        F.when(F.col("k") == 0, F.col("end_at") + horizon_days * MICROS_PER_DAY)
        .otherwise(F.col("end_at") + F.col("k") * MICROS_PER_DAY - 1)
        .alias("at"),
        "k",
    )
    points = starts.withColumn("is_start", F.lit(True)).unionByName(marks.withColumn("is_start", F.lit(False)))
    timeline = _running(points.withColumn("is_end", F.lit(False)), hot, MICROS_PER_DAY)
    # The horizon point counts once per day mark, each day mark takes away the returns before it.
    sign = F.when(F.col("k") == 0, F.col("starts_upto") * horizon_days).otherwise(-F.col("starts_upto"))
    summed = timeline.where(F.col("visit").isNotNull()).groupBy("patient", "visit").agg(F.sum(sign).alias("day_sum"))
    return single.unionByName(summed.select("visit", "day_sum"))
