"""Data-quality reports: audit, turnout gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def voter_conflicts(rows: DataFrame) -> DataFrame:
    """One row: records, voters, and voters with several rows, dates, methods, counties, names, precincts.

    Smallest and largest values per voter tell whether there are several, so voters are combined before the
    shuffle and no sets are gathered."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    columns = {"multiple_dates": "report_date", "conflicting_method": "voting_method", "multiple_counties": "county", "name_mismatch": "voter_name", "precinct_mismatch": "precinct"}
    per_voter = rows.groupBy("id_voter").agg(F.count("*").alias("n"), *[(F.min(blank(c)) != F.max(blank(c))).alias(k) for k, c in columns.items()])
    return per_voter.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"), F.count("*").alias("unique_voters"), F.count_if(F.col("n") > 1).alias("duplicate_vuid"), *[F.count_if(k).alias(k) for k in columns])


def audit_findings(rows: DataFrame, turnout: DataFrame) -> DataFrame:
    """AGG11: finding_type, severity, county, affected, for the eight checks; only those that found something."""
    severity = {"multiple_dates": "warning", "duplicate_vuid": "warning", "conflicting_method": "error", "multiple_counties": "error", "name_mismatch": "warning", "precinct_mismatch": "warning"}
    found = F.array(*[F.struct(F.lit(k).alias("finding_type"), F.lit(s).alias("severity"), F.lit(None).cast("string").alias("county"), F.col(k).cast("long").alias("affected")) for k, s in severity.items()])
    voters = voter_conflicts(rows).select(F.explode(found).alias("x")).select("x.*").where("affected > 0")
    over = turnout_anomaly(rows, turnout).select(F.lit("turnout_anomaly").alias("finding_type"), F.lit("warning").alias("severity"), "county", "excess")
    missing = missing_counties(rows, turnout).select(F.lit("missing_county"), F.lit("warning"), "county", F.lit(1).cast("long"))
    return voters.union(over).union(missing)


def turnout_anomaly(rows: DataFrame, turnout: DataFrame) -> DataFrame:
    """JON05: turnout rows of counties that list more rows than voters are registered, and the excess."""
    n = rows.groupBy(F.upper("county").alias("key")).agg(F.count("*").alias("n"))
    joined = turnout.join(n, F.upper(turnout["county"]) == n["key"])
    return joined.where("registered_voters > 0 and n > registered_voters").select("county", "n", "registered_voters", (F.col("n") - F.col("registered_voters")).alias("excess"))


def missing_counties(rows: DataFrame, turnout: DataFrame) -> DataFrame:
    """JON04: turnout rows whose county has no roster row, whatever the case."""
    return turnout.withColumn("key", F.upper("county")).join(rows.select(F.upper("county").alias("key")).distinct(), "key", "left_anti").drop("key")


def roster_by_county(rows: DataFrame) -> DataFrame:
    """AGG12, SET05: per county the distinct voters in person, by mail only, and of either."""
    flags = rows.groupBy("county", "id_voter").agg(F.max(F.col("voting_method") == "IN-PERSON").alias("ip"), F.max(F.col("voting_method") == "MAIL-IN").alias("mail"))
    return flags.groupBy("county").agg(F.count_if("ip").alias("roster_in_person"), F.count_if(F.col("mail") & ~F.col("ip")).alias("roster_mail"), F.count_if(F.col("ip") | F.col("mail")).alias("roster_total")).where("roster_total > 0")


def gap_report(rows: DataFrame, turnout: DataFrame, pos: str = "county_id") -> DataFrame:
    """AGG13, JON03: per county the published and the listed voters and their gaps.

    Counties of either side; the other side is 0. Of several turnout rows of a county the last by ``pos``
    counts. gap_pct is 0 without turnout."""
    last = turnout.groupBy("county").agg(F.max_by(F.struct("county_id", "registered_voters", "total_in_person_votes", "total_mail_votes"), pos).alias("t")).select("county", "t.*")
    both = last.join(roster_by_county(rows), "county", "full_outer")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    out = both.select("county", "county_id", zero("registered_voters").alias("registered_voters"), zero("total_in_person_votes").alias("turnout_in_person"), zero("total_mail_votes").alias("turnout_mail"), zero("roster_in_person").alias("roster_in_person"), zero("roster_mail").alias("roster_mail"), zero("roster_total").alias("roster_total"))
    out = out.withColumn("turnout_total", F.col("turnout_in_person") + F.col("turnout_mail"))
    for c in ("in_person", "mail", "total"):
        out = out.withColumn(f"gap_{c}", F.col(f"turnout_{c}") - F.col(f"roster_{c}"))
    return out.withColumn("gap_pct", F.when(F.col("turnout_total") != 0, F.col("gap_total") / F.col("turnout_total")).otherwise(0.0))


def gap_summary(gaps: DataFrame, rows: DataFrame) -> DataFrame:
    """AGG13: the statewide row: sums, share, counties with a gap and over, rows and distinct voters."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for side in ("turnout", "roster", "gap") for c in (f"{side}_in_person", f"{side}_mail", f"{side}_total")]
    state = gaps.agg(*sums, F.count_if(F.col("gap_total") > 0).alias("counties_with_gap"), F.count_if(F.col("gap_total") < 0).alias("counties_roster_over_turnout"))
    state = state.withColumn("gap_pct", F.when(F.col("turnout_total") != 0, F.col("gap_total") / F.col("turnout_total")).otherwise(0.0))
    return state.crossJoin(F.broadcast(rows.agg(F.count("*").alias("roster_rows"), F.count_distinct("id_voter").alias("roster_unique"))))


def largest_gaps(gaps: DataFrame, n: int = 10) -> DataFrame:
    """TOP01: the n largest positive gaps; equal ones by county."""
    return gaps.where("gap_total > 0").orderBy(F.desc("gap_total"), "county").limit(n)
