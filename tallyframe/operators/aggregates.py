"""Totals per day, county and method, from roster rows and from published counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions.scalars import normalize_method

COUNTS = ("in_person", "mail_in", "total")


def method_counts() -> list[Column]:
    method = F.col("__method")
    return [F.count_if(method == "in_person").alias("in_person"), F.count_if(method == "mail_in").alias("mail_in"), F.count("*").alias("total")]


def roster_totals(rows: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """AGG01: county rows and, with a null county, the statewide row: in_person, mail_in, total.

    Rows of an unknown method are dropped, and so is a county that has only such rows; counties are trimmed
    and upper-cased. One shuffle of partial counts makes both levels."""
    known = rows.withColumn("__method", normalize_method("voting_method")).where("__method is not null").withColumn("__county", F.upper(F.trim("county")))
    return known.groupingSets([[*by, "__county"], [*by]], *by, "__county").agg(*method_counts()).withColumnRenamed("__county", "county")


def turnout_totals(rows: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """AGG02: the same from published counts (name, in_person, mail_in); rows without a name are left out."""
    named = rows.withColumn("county", F.trim("county")).where("county != ''")
    sums = [F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in COUNTS[:2]]
    return named.groupingSets([[*by, "county"], [*by]], *by, "county").agg(*sums).withColumn("total", F.col("in_person") + F.col("mail_in"))


def by_day_series(rows: DataFrame) -> DataFrame:
    """AGG03: totals per ev_date."""
    known = rows.withColumn("__method", normalize_method("voting_method")).where("__method is not null")
    return known.groupBy("ev_date").agg(*method_counts())


def county_by_day(rows: DataFrame) -> DataFrame:
    """AGG04: totals per ev_date and county."""
    known = rows.withColumn("__method", normalize_method("voting_method")).where("__method is not null")
    return known.groupBy("ev_date", F.upper(F.trim("county")).alias("county")).agg(*method_counts())


def running_totals(days: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """WIN01: cumulative in_person, mail_in and total over ev_date; one row per day, so few."""
    upto = Window.partitionBy(*by).orderBy("ev_date").rowsBetween(Window.unboundedPreceding, 0)
    return days.withColumns({f"cumulative_{c}": F.sum(c).over(upto) for c in COUNTS})


def cumulative_totals(days: DataFrame) -> DataFrame:
    """AGG05: per county (null: statewide) sums of days (ev_date, kind, county, in_person, mail_in), the
    days, the last of them, and their kind or ``mixed``."""
    grouped = days.groupingSets([["county"], []], "county").agg(
        F.sum("in_person").alias("in_person"),
        F.sum("mail_in").alias("mail_in"),
        F.sum(F.col("in_person") + F.col("mail_in")).alias("total"),
        F.min("kind").alias("__least"),
        F.max("kind").alias("__most"),
        F.array_join(F.transform(F.array_sort(F.collect_set("ev_date")), lambda d: F.date_format(d, "yyyy-MM-dd")), ",").alias("days"),
        F.max("ev_date").alias("through"),
    )
    return grouped.withColumn("kind", F.when(F.col("__least") == F.col("__most"), F.col("__least")).otherwise("mixed")).drop("__least", "__most")


def method_slice(totals: DataFrame) -> DataFrame:
    """PRJ06: the split by method, without totals."""
    return totals.drop("total")


def roster_summary(rows: DataFrame) -> DataFrame:
    """AGG21: dimension, value, n for trimmed methods and counties (blanks left out), and the row count."""
    parts = F.array(F.struct(F.lit("method").alias("dimension"), F.trim("voting_method").alias("value")), F.struct(F.lit("county").alias("dimension"), F.trim("county").alias("value")), F.struct(F.lit("rows").alias("dimension"), F.lit("all").alias("value")))
    return rows.select(F.explode(parts).alias("x")).where("x.value != ''").groupBy("x.dimension", "x.value").agg(F.count("*").alias("n"))


def low_coverage(day: DataFrame, early: DataFrame, share: float = 0.1, least: int = 100) -> DataFrame:
    """AGG20: counties whose rows of ``day`` are under ``share`` of their mean over all early days.

    The mean divides by all days loaded, is rounded half to even and must be ``least`` or more; a county
    that the day lacks has 0 rows."""
    days = early.agg(F.count_distinct("ev_date").alias("n_days"))
    mean = early.groupBy(F.upper(F.trim("county")).alias("county")).agg(F.count("*").alias("n_early"))
    mean = mean.crossJoin(F.broadcast(days)).withColumn("baseline", F.bround(F.col("n_early") / F.col("n_days")).cast("long"))
    own = day.groupBy(F.upper(F.trim("county")).alias("county")).agg(F.count("*").alias("n"))
    out = mean.join(own, "county", "left").select("county", F.coalesce("n", F.lit(0)).alias("rows"), "baseline")
    return out.where((F.col("baseline") >= least) & (F.col("rows") < share * F.col("baseline")))


def precompute(rows: DataFrame, file_key: str = "file_id") -> DataFrame:
    """AGG22: per file, its statewide row (null county) and its counties, and how many there are."""
    totals = roster_totals(rows, (file_key,))
    return totals.withColumn("n_counties", F.count("county").over(Window.partitionBy(file_key)))


def complete_files(meta: DataFrame, stored: DataFrame, file_key: str = "file_id") -> DataFrame:
    """AGG22: files whose stored county rows are as many as ``meta`` (file, n_counties) expects."""
    present = stored.where("county is not null").groupBy(file_key).agg(F.count("*").alias("present"))
    out = meta.join(present, file_key, "left").withColumn("present", F.coalesce("present", F.lit(0)))
    return out.withColumn("complete", F.col("present") == F.col("n_counties"))


def election_summary(rows: DataFrame) -> DataFrame:
    """AGG23: per election its first and last day, rows, and the rows of each day as text."""
    days = rows.groupBy("election_id", "ev_date").agg(F.count("*").alias("n"))
    listed = F.transform(F.sort_array(F.collect_list(F.struct("ev_date", "n"))), lambda x: F.concat_ws(":", F.date_format(x["ev_date"], "yyyy-MM-dd"), x["n"].cast("string")))
    return days.groupBy("election_id").agg(F.min("ev_date").alias("first_day"), F.max("ev_date").alias("last_day"), F.sum("n").alias("total_rows"), F.array_join(listed, ",").alias("days"))
