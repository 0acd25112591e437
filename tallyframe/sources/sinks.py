"""Frames as files (SNK01-SNK10), and versions that readers find through a manifest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe import schemas
from tallyframe.operators.versions import diff_upsert


def write_roster_csv(df: DataFrame, path: str) -> None:
    """SNK01: ten columns, all quoted, booleans as lower-case text."""
    df.select(*[F.col(c).cast("string").alias(c) for c in schemas.ROSTER_CSV]).write.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)


def write_enriched_csv(df: DataFrame, path: str) -> None:
    """SNK02: roster and register columns; nulls are empty."""
    columns = [*schemas.ROSTER_CSV, *schemas.ENRICHED_CSV]
    renamed = df.withColumnRenamed("in_register", "in_voterfile")
    df = renamed.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns if c in renamed.columns])
    df.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)


def write_turnout_csv(df: DataFrame, path: str) -> None:
    """SNK03."""
    df.select(*[F.col(c).cast("string").alias(c) for c in schemas.TURNOUT_CSV]).write.option("header", True).csv(path)


def write_gap_report(gaps: DataFrame, summary: DataFrame, path: str) -> None:
    """SNK04: the statewide row as JSON, the counties as CSV."""
    summary.write.json(f"{path}/summary")
    gaps.orderBy("county").write.option("header", True).csv(f"{path}/counties")


def write_report(findings: DataFrame, summary: DataFrame, path: str) -> None:
    """SNK05: findings and summary as JSON lines; neither holds ids."""
    findings.write.json(f"{path}/findings")
    summary.write.json(f"{path}/summary")


def apply_upsert(spark: SparkSession, path: str, new: DataFrame, key: Sequence[str], value_hash: str, version: int, dry_run: bool = False) -> tuple[DataFrame, DataFrame]:
    """SNK06: find what differs from the published version and, unless ``dry_run``, publish a new one.

    Unchanged rows come from the stored files; the manifest's row goes last."""
    stored = read_published(spark, path)
    write, delete = diff_upsert(stored, new, key, value_hash)
    if not dry_run:
        gone = delete.select(*key).union(write.select(*key)).distinct()
        publish(stored.join(gone, list(key), "left_anti").unionByName(write), path, version)
    return write, delete


def publish(df: DataFrame, path: str, version: int, signature: str = "") -> None:
    """SNK07: the data in a directory of its own first, then one manifest row that names it. A crash in
    between leaves a directory that no reader looks at."""
    df.write.mode("overwrite").parquet(f"{path}/data/v={version}")
    row = [(version, signature)]
    df.sparkSession.createDataFrame(row, "version int, signature string").coalesce(1).write.mode("append").parquet(f"{path}/manifest")


def published_version(spark: SparkSession, path: str) -> tuple[int, str] | None:
    """The last manifest row: version and signature."""
    row = spark.read.parquet(f"{path}/manifest").orderBy(F.desc("version")).first()
    return (row["version"], row["signature"]) if row else None


def read_published(spark: SparkSession, path: str) -> DataFrame:
    version, _ = published_version(spark, path) or (None, None)
    if version is None:
        raise ValueError("nothing is published")
    return spark.read.parquet(f"{path}/data/v={version}")


def snapshot_versions(rows: DataFrame, manifest: DataFrame | None, path: str) -> DataFrame:
    """SNK08: keep every version that is replaced, once per (ev_date, sha256); gives the manifest's new rows."""
    new = rows if manifest is None else rows.join(manifest.select("ev_date", "sha256"), ["ev_date", "sha256"], "left_anti")
    new.write.mode("append").partitionBy("ev_date", "sha256").option("compression", "gzip").parquet(path)
    return new.groupBy("ev_date", "sha256").agg(F.count("*").alias("n_rows"))


def export_days(rows: DataFrame, path: str, one_file: bool = False) -> None:
    """SNK09: all days, EV_DATE first, in order of the day."""
    out = rows.select(F.col("ev_date").alias("EV_DATE"), *[c for c in rows.columns if c != "ev_date"]).orderBy("EV_DATE")
    (out.coalesce(1) if one_file else out).write.option("header", True).csv(path)


def election_index(rows: DataFrame, meta: DataFrame) -> DataFrame:
    """SNK10: per election total_records, unique_voters, duplicate_voters, and its metadata."""
    per_voter = rows.groupBy("election_id", "id_voter").agg(F.count("*").alias("n"))
    counts = per_voter.groupBy("election_id").agg(F.sum("n").alias("total_records"), F.count("*").alias("unique_voters"), F.count_if(F.col("n") > 1).alias("duplicate_voters"))
    return counts.join(meta, "election_id", "left")
