"""Month plans as DataFrames: which extracts a request needs, and which exist."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

FILE_MONTH = r"_(\d{4})[-_](\d{2})\.[A-Za-z0-9]+$"


def month_ranges(requests: DataFrame) -> DataFrame:
    """One row for each month from start's to end's: month_start, month_end = the sooner of next month's start and end.

    Extracts begin on the first day of start's month; an end on a month's first instant gives a last
    month of no length, which the data source answers with nothing.
    """
    first = F.date_trunc("month", "start").cast("timestamp_ntz")
    months = requests.where("start <= end or date_trunc('month', start) <= end").select("*", F.explode(F.sequence(first, F.col("end"), F.expr("interval 1 month"))).alias("month_start"))
    following = (F.col("month_start") + F.expr("interval 1 month")).cast("timestamp_ntz")
    return months.select(*requests.columns, "month_start", F.least(following, F.col("end")).alias("month_end"))


def month_plan(requests: DataFrame) -> DataFrame:
    """One row (.., year, month) for each month from start's to end's, both included."""
    months = F.sequence(F.trunc("start", "month"), F.trunc("end", "month"), F.expr("interval 1 month"))
    return requests.select("*", F.explode(months).alias("first_day")).select(*requests.columns, F.year("first_day").alias("year"), F.month("first_day").alias("month"))


def month_days(plan: DataFrame) -> DataFrame:
    """Adds `days`: the month's days as two digits."""
    first = F.make_date("year", "month", F.lit(1))
    days = F.transform(F.sequence(F.lit(1), F.day(F.last_day(first))), lambda d: F.lpad(d.cast("string"), 2, "0"))
    return plan.withColumn("days", days)


def present_months(listing: DataFrame, base: str) -> DataFrame:
    """year, month and path of files named base_YYYY-MM.ext or base_YYYY_MM.ext, the first path of each month."""
    name = F.element_at(F.split("path", "/"), -1)
    tail = F.substring(name, len(base) + 1, F.length(name))
    named = listing.where(name.startswith(base) & tail.rlike("^" + FILE_MONTH))
    return named.select(F.regexp_extract(tail, FILE_MONTH, 1).cast("int").alias("year"), F.regexp_extract(tail, FILE_MONTH, 2).cast("int").alias("month"), "path").groupBy("year", "month").agg(F.min("path").alias("path"))


def plan_skip_existing(plan: DataFrame, present: DataFrame) -> DataFrame:
    """Months still to fetch."""
    return plan.join(present, ["year", "month"], "left_anti")


def plan_present(plan: DataFrame, present: DataFrame) -> DataFrame:
    """Months that need no fetch."""
    return plan.join(present, ["year", "month"], "left_semi")


def plan_by_policy(plan: DataFrame, present: DataFrame, policy: str) -> DataFrame:
    """Adds one status to each month: fetch, skip or overwrite."""
    if policy not in ("skip_all", "overwrite_all", "case_by_case"):
        raise ValueError(f"unknown policy {policy!r}")
    found = plan.join(present.select("year", "month", F.lit(True).alias("found")), ["year", "month"], "left")
    return found.withColumn("status", F.when(F.col("found").isNull(), "fetch").otherwise("overwrite" if policy == "overwrite_all" else "skip")).drop("found")


def status_report(plan: DataFrame, most: int) -> DataFrame:
    """Of each status the number of months, the first `most` of them in order, and a line that tells how many more there are.

    Only the first months of a status are gathered.
    """
    order = Window.partitionBy("status").orderBy("year", "month")
    name = F.concat_ws("-", F.lpad(F.col("year").cast("string"), 4, "0"), F.lpad(F.col("month").cast("string"), 2, "0"))
    first = plan.select("status", F.row_number().over(order).alias("k"), name.alias("name")).where(F.col("k") <= most)
    named = first.groupBy("status").agg(F.array_sort(F.collect_list("name")).alias("first"))
    both = plan.groupBy("status").agg(F.count("*").alias("n")).join(named, "status")
    more = F.when(F.col("n") > most, F.concat(F.lit(" and "), (F.col("n") - most).cast("string"), F.lit(" more"))).otherwise(F.lit(""))
    return both.select("status", "n", F.concat(F.array_join("first", ", "), more).alias("line"))
