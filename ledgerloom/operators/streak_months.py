"""Streaks from month summaries that can be joined.

A month of one series (store x product) is summed up, for each treatment of unknown
readings, by the length of its axis, the runs that touch its head and its tail, and the
lengths of the runs inside. Two summaries of consecutive spans make the summary of both:
the tail of the first and the head of the second become one run. That join is associative, so
months are merged to years and years to the whole history, no series is ever
sorted as a whole, and a new month is one more summary beside those that stand.

A run inside can grow no more, so only those longer than ``min_days`` are kept. The grain of the
readings (day, store, product) must be unique. Rows without date, store or product belong to no series.
An absent day, or month, ends a run, except where unknown readings are bridged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .marts import MIN_STREAK_DAYS, SCENARIOS, SERIES

SPAN = ["first_day", "last_day", "n", "head", "tail", "inside"]

#: What a day's sign (zero, unknown, other, absent) is under each treatment: a hit, a miss, or left out.
_TREATMENTS = {SCENARIOS[0]: ("ZU.-", "1000"), SCENARIOS[1]: ("Z.U-", "10"), SCENARIOS[2]: ("ZU.-", "1100")}


def _sign() -> Column:
    zero = F.col("reading_valid") & (F.col("units") == 0)
    return F.when(~F.col("reading_valid"), "U").when(zero, "Z").otherwise(".")


def _lengths(hits: Column) -> Column:
    return F.transform(hits, lambda run: F.length(run).cast("long"))


def month_summaries(inventory: DataFrame, min_days: int = MIN_STREAK_DAYS) -> DataFrame:
    """``inventory(date, store_id, product_key, units, reading_valid)`` -> one summary for each
    scenario, series and month: ``month`` and ``first_day, last_day, n, head, tail, inside``."""
    day = F.struct(F.dayofmonth("date").alias("d"), _sign().alias("sign"))
    month = F.trunc("date", "month")
    # a month has 31 days at most, which bounds the list
    known = inventory.where("date is not null and store_id is not null and product_key is not null")
    days = known.groupBy(*SERIES, month.alias("month")).agg(F.array_sort(F.collect_list(day)).alias("days"))
    # days are put behind one another, with absent ones between; most series have few in a month
    repeated = F.raise_error(F.lit("a store, product and day has several readings"))
    step = lambda line, x: F.when(x.d <= F.length(line), repeated).otherwise(F.concat(F.rpad(line, x.d - 1, "-"), x.sign))
    known_days = F.aggregate("days", F.lit(""), step)
    line = F.rpad(known_days, F.dayofmonth(F.last_day("month")), "-")
    cases = F.array(*[
        F.struct(F.lit(name).alias("scenario"), F.translate("line", old, new).alias("axis")) for name, (old, new) in _TREATMENTS.items()
    ])
    rows = days.withColumn("line", line).select(*SERIES, "month", F.explode(cases).alias("case")).select(*SERIES, "month", "case.*")
    head, tail = (F.length(F.regexp_extract("axis", p, 0)).cast("long") for p in ("^1+", "1+$"))
    inside = F.regexp_extract_all("axis", F.lit("(?<=0)1+(?=0)"), F.lit(0))
    return rows.select(
        "scenario", *SERIES, "month",
        F.unix_date("month").cast("long").alias("first_day"), F.unix_date(F.last_day("month")).cast("long").alias("last_day"),
        F.length("axis").cast("long").alias("n"), head.alias("head"), tail.alias("tail"),
        F.filter(_lengths(inside), lambda days: days > min_days).alias("inside"),
    )


def join_spans(a: Column, b: Column, min_days: int) -> Column:
    """The summary of span ``a`` followed by span ``b``."""
    met = a.tail + b.head
    closed = (a.tail < a.n) & (b.head < b.n) & (met > min_days)
    none = F.array().cast("array<bigint>")
    return F.struct(
        a.first_day.alias("first_day"), b.last_day.alias("last_day"), (a.n + b.n).alias("n"),
        F.when(a.head == a.n, a.n + b.head).otherwise(a.head).alias("head"),
        F.when(b.tail == b.n, b.n + a.tail).otherwise(b.tail).alias("tail"),
        F.concat(a.inside, F.when(closed, F.array(met)).otherwise(none), b.inside).alias("inside"),
    )


def _absent(a: Column, b: Column, bridged: Column) -> Column:
    """The days between two spans, as a span without hits."""
    n = F.when(bridged, F.lit(0)).otherwise(b.first_day - a.last_day - 1).cast("long")
    zero = F.lit(0).cast("long")
    return F.struct(
        a.first_day.alias("first_day"), a.last_day.alias("last_day"), n.alias("n"), zero.alias("head"), zero.alias("tail"),
        F.array().cast("array<bigint>").alias("inside"),
    )


def merge_summaries(parts: DataFrame, by: Sequence[str] = (), min_days: int = MIN_STREAK_DAYS) -> DataFrame:
    """One summary for each scenario, series and value of the columns ``by``. Spans of a group
    must not overlap; a group holds as many as its level has parts (twelve months of a year)."""
    keys = ["scenario", *SERIES, *by]
    rows = parts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*SPAN))).alias("spans"))
    bridged = F.col("scenario") == SCENARIOS[1]
    step = lambda a, b: join_spans(join_spans(a, _absent(a, b, bridged), min_days), b, min_days)
    whole = F.aggregate(F.slice("spans", F.lit(2), F.size("spans")), F.element_at("spans", 1), step)
    return rows.select(*keys, whole.alias("span")).select(*keys, "span.*")


def merge_history(months: DataFrame, min_days: int = MIN_STREAK_DAYS) -> DataFrame:
    """One summary for each scenario and series: months to years, years to decades, those to the whole. Summaries
    are dealt by series once, and all levels merge where they lie."""
    months = months.repartition("scenario", *SERIES)
    years = merge_summaries(months.withColumn("year", F.year("month")), ["year"], min_days)
    decades = merge_summaries(years.withColumn("decade", F.floor(F.col("year") / 10)), ["decade"], min_days)
    return merge_summaries(decades, [], min_days)


def runs_of(summary: DataFrame, min_days: int = MIN_STREAK_DAYS) -> DataFrame:
    """``scenario, store_id, product_key, days`` of every run longer than ``min_days``."""
    whole = F.col("head") == F.col("n")
    edges = F.when(whole, F.array("head")).otherwise(F.array("head", "tail"))
    runs = F.filter(F.concat("inside", edges), lambda days: days > min_days)
    return summary.select("scenario", *SERIES, F.explode(runs).alias("days"))
