"""Joins the jobs share: as-of, calendar, account and cleaned-key lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patio.functions.keys import match_key
from patio.session import materialize


def time_bucket(df: DataFrame, time: str) -> Column:
    """The month of a date or timestamp; other points in time form one bucket."""
    kind = df.schema[time].dataType.typeName()
    return F.trunc(time, "month") if kind in ("date", "timestamp", "timestamp_ntz") else F.lit(0)


def asof_before(
    left: DataFrame,
    right: DataFrame,
    by: str,
    time: str,
    values: Sequence[str],
    bucket: Column | None = None,
) -> DataFrame:
    """Each left row with the latest right row of the same `by` and a strictly earlier `time`.

    Both sides are first reduced to one row per (by, time). A key with very many points is cut
    into buckets of time (by default months; `bucket` is a rising function of `time`): a window
    holds one bucket of a key, and what a bucket starts with is the last row of the buckets
    before it, found over one row per bucket.
    """
    span = time_bucket(left, time) if bucket is None else bucket
    points = left.select(by, time).distinct()
    picked = [F.max_by(F.col(v), F.struct(*[F.col(x) for x in values])).alias(v) for v in values]
    steps = right.groupBy(by, time).agg(*picked)
    # Stored, because the buckets and the rows inside them both read it.
    tagged = materialize(
        points.select(by, time, F.lit(0).alias("_side"), *[F.lit(None).cast(steps.schema[v].dataType).alias(v) for v in values])
        .unionByName(steps.select(by, time, F.lit(1).alias("_side"), *values))
        .withColumn("_lapso", span)
        .repartition(by, "_lapso")
    )
    step = F.when(F.col("_side") == 1, F.struct(*values))
    # A left point sorts before a right row of the same time, which keeps the match strict.
    inside = Window.partitionBy(by, "_lapso").orderBy(time, "_side").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(by).orderBy("_lapso").rowsBetween(Window.unboundedPreceding, -1)
    starts = tagged.groupBy(by, "_lapso").agg(F.max_by(step, F.when(F.col("_side") == 1, F.col(time))).alias("_ultimo"))
    carried = starts.select(by, "_lapso", F.last("_ultimo", ignorenulls=True).over(before).alias("_traido"))
    answers = (
        tagged.withColumn("_prev", F.last(step, ignorenulls=True).over(inside))
        .filter("_side = 0")
        .join(carried, [by, "_lapso"])
        .withColumn("_prev", F.coalesce("_prev", "_traido"))
        .filter("_prev IS NOT NULL")
        .select(by, time, *[F.col(f"_prev.{v}").alias(f"prev_{v}") for v in values])
    )
    return left.join(answers, [by, time], "left")


def sum_or_zero(
    base: DataFrame, facts: DataFrame, base_key: str, fact_key: str, amount: str, name: str
) -> DataFrame:
    """Base with the total of its facts; 0 where there are none. Facts shrink before the join."""
    totals = (
        facts.filter(F.col(fact_key).isNotNull())
        .groupBy(F.col(fact_key).alias("_key"))
        .agg(F.sum(amount).alias("_total"))
    )
    joined = base.join(totals, F.col(base_key) == F.col("_key"), "left")
    return joined.select(*base.columns, F.coalesce("_total", F.lit(0)).alias(name))


def candidate_days(first: Column, horizon: int) -> Column:
    return F.sequence(first, F.date_add(first, horizon))


def next_free_days(
    days: DataFrame, column: str, holidays: DataFrame, horizon: int = 10, skip_weekends: bool = False
) -> DataFrame:
    """For each distinct day, the first of the day and the next `horizon` that is no holiday.

    A day whose candidates are all taken is left out: looking it up gives NULL.
    """
    options = days.select(F.col(column).alias("dia")).distinct().select(
        "dia", F.explode(candidate_days(F.col("dia"), horizon)).alias("posible")
    )
    if skip_weekends:
        options = options.filter(F.weekday("posible") < 5)
    taken = holidays.select(F.col("fecha").alias("posible"))
    free = options.join(taken, "posible", "left_anti")
    return free.groupBy("dia").agg(F.min("posible").alias("dia_habil"))


def with_next_free_day(
    facts: DataFrame, column: str, holidays: DataFrame, name: str, horizon: int = 10
) -> DataFrame:
    """Facts with the first free day; the calendar work is done once per distinct day."""
    table = next_free_days(facts, column, holidays, horizon).withColumnRenamed("dia_habil", name)
    return facts.join(table, facts[column] == table["dia"], "left").select(*facts.columns, name)


def account_owner(units: DataFrame) -> DataFrame:
    """Each account with its lowest unit and how many units share it."""
    return (
        units.filter(F.col("cbu_cvu_actual").isNotNull())
        .groupBy(F.col("cbu_cvu_actual").alias("cbu"))
        .agg(
            F.min("idUF").cast("bigint").alias("idUF"),
            F.count_distinct("idUF").alias("unidades"),
        )
    )


def group_by_name(rows: DataFrame, name: Column, groups: DataFrame, how: str = "inner") -> DataFrame:
    """Attach `idConsorcio` by the group's name, ignoring case and trailing blanks."""
    lookup = groups.select(F.col("id").alias("idConsorcio"), match_key(F.col("nombre")).alias("_group"))
    return rows.join(lookup, match_key(name) == F.col("_group"), how).drop("_group")
