"""Days and pages as files that later work reads without shuffling or scanning all of them.

A day's rows lie in buckets of their key, a folder per day and version, so that loading a day's next file moves only
the new rows and writes only that day. Pages lie in ranges of (row_hash, occ), with a list of files and their ranges,
so that a page opens the files that it comes from.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.operators.versions import KEY

#: Rows of a bucket, about, at most: what a task merges and sorts.
BUCKET_ROWS = 1 << 20

DAYS = "day int, version int, folder string, buckets int, n_rows long"


def stored_days(spark: SparkSession, path: str) -> DataFrame:
    """The manifest: a row for each version of each day."""
    try:
        return spark.read.schema(DAYS).parquet(f"{path}/manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], DAYS)


def _latest(spark: SparkSession, path: str, day: int):
    return stored_days(spark, path).where(F.col("day") == day).orderBy(F.desc("version")).first()


def bucketed(spark: SparkSession, folder: str, buckets: int) -> DataFrame:
    """A folder of bucket files as a frame that knows its buckets."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(folder).schema.fields)
    name, keys = f"day_{uuid.uuid4().hex}", ", ".join(KEY)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{folder}'")
    rows = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the frame has the files and their buckets; the catalogue needs no entry
    return rows


def _write(rows: DataFrame, path: str, day: int, version: int, buckets: int) -> None:
    spark = rows.sparkSession
    folder, name = f"{path}/day={day}/v={version}", f"day_{uuid.uuid4().hex}"
    # the catalogue's entry goes, the files stay: the manifest is what readers go by
    rows.write.mode("overwrite").format("parquet").bucketBy(buckets, *KEY).sortBy(*KEY).option("path", folder).saveAsTable(name)
    n = spark.table(name).count()
    spark.sql(f"DROP TABLE {name}")
    row = spark.createDataFrame([(day, version, folder, buckets, n)], DAYS)
    row.coalesce(1).write.mode("append").parquet(f"{path}/manifest")


def stored_day(spark: SparkSession, path: str, day: int) -> DataFrame | None:
    """The latest version's rows of a day, removed ones included; None where it isn't stored."""
    row = _latest(spark, path, day)
    return bucketed(spark, row["folder"], row["buckets"]) if row else None


def merged_day(stored: DataFrame, new: DataFrame, version: int) -> DataFrame:
    """VER01, VER03 as one full outer join by key: as ``load_day_version``, but stored rows stay where their buckets are."""
    own = F.struct(*[F.col(c) for c in stored.columns]).alias("own")
    added = new.withColumn("added_in", F.lit(version + 1)).withColumn("removed_in", F.lit(None).cast("int"))
    other = F.struct(*[F.col(c) for c in stored.columns]).alias("other")
    left = stored.select(*KEY, own)
    right = added.select(*[F.col(c).alias(f"__{c}") for c in KEY], other)
    same = [F.col(c) == F.col(f"__{c}") for c in KEY]
    # a removed row meets nothing: a key that comes again gets a row of its own
    both = left.join(right, [*same, F.col("own.removed_in").isNull()], "full_outer")
    gone = F.col("other").isNull() & F.col("own.removed_in").isNull()
    kept = F.col("own").withField("removed_in", F.when(gone, F.lit(version + 1)).otherwise(F.col("own.removed_in")))
    return both.select(F.when(F.col("own").isNotNull(), kept).otherwise(F.col("other")).alias("x")).select("x.*")


def enough_buckets(buckets: int, n_rows: int) -> int:
    """``buckets``, doubled until each has BUCKET_ROWS rows at most."""
    while n_rows > buckets * BUCKET_ROWS:
        buckets *= 2
    return buckets


def load_stored_day(spark: SparkSession, path: str, day: int, new: DataFrame, buckets: int = 32) -> int:
    """VER01-VER03 on stored files: the day's next version from the rows (key and content) of a new file; gives its
    number. The first load of a day decides its buckets, at least ``buckets`` and enough for twice its rows; where a later file may
    make them too large, stored rows are shuffled once, into more. The manifest's row comes last; other days' files aren't touched."""
    row, n_new = _latest(spark, path, day), new.count()
    if row is None:
        buckets = enough_buckets(buckets, 2 * n_new)
        first = new.withColumn("added_in", F.lit(1)).withColumn("removed_in", F.lit(None).cast("int"))
        _write(first.repartition(buckets, *KEY), path, day, 1, buckets)  # a file for each bucket
        return 1
    stored, buckets = bucketed(spark, row["folder"], row["buckets"]), enough_buckets(row["buckets"], row["n_rows"] + n_new)
    if buckets > row["buckets"]:
        stored = stored.repartition(buckets, *KEY)
    _write(merged_day(stored, new, row["version"]), path, day, row["version"] + 1, buckets)
    return row["version"] + 1


def on_stored_day(spark: SparkSession, path: str, day: int, change: Callable[[DataFrame], DataFrame]) -> int:
    """VER04, VER06: write a day again after a change of its own rows (``recovered``, ``collected``), bucket by bucket."""
    row = _latest(spark, path, day)
    if row is None:
        raise ValueError("the day isn't stored")
    _write(change(bucketed(spark, row["folder"], row["buckets"])), path, day, row["version"] + 1, row["buckets"])
    return row["version"] + 1


FILES = "file string, low struct<row_hash:long,occ:int>, high struct<row_hash:long,occ:int>, n long"


def store_pages(rows: DataFrame, path: str, files: int) -> None:
    """Rows in about ``files`` files of rising ranges of (row_hash, occ), and the list of them."""
    key = F.struct(F.col("row_hash").cast("long").alias("row_hash"), F.col("occ").cast("int").alias("occ"))
    rows.repartitionByRange(files, "row_hash", "occ").sortWithinPartitions("row_hash", "occ").write.parquet(f"{path}/rows")
    written = rows.sparkSession.read.parquet(f"{path}/rows").select(F.col("_metadata.file_path").alias("file"), key.alias("key"))
    listed = written.groupBy("file").agg(F.min("key").alias("low"), F.max("key").alias("high"), F.count("*").alias("n"))
    listed.coalesce(1).write.parquet(f"{path}/files")


def stored_page(spark: SparkSession, path: str, after: tuple[int, int] | None, n: int) -> DataFrame:
    """TOP03 on stored pages: the next n rows after a key. Files are opened in order of their ranges until they surely hold
    n rows, so a page reads a few files whatever the table's size."""
    listed = spark.read.schema(FILES).parquet(f"{path}/files")
    start = F.struct(F.lit(after[0]).cast("long").alias("row_hash"), F.lit(after[1]).cast("int").alias("occ")) if after else None
    listed = listed.where(F.col("high") > start) if after else listed
    chosen, sure = [], 0
    for k, row in enumerate(listed.select("file", "n").orderBy("low").toLocalIterator()):
        chosen.append(row["file"])
        sure += row["n"] if k or after is None else 0  # of the first file only rows beyond the key count
        if sure >= n:
            break
    return _page(spark, path, chosen, start).orderBy("row_hash", "occ").limit(n)


def stored_range(spark: SparkSession, path: str, low: int, high: int) -> DataFrame:
    """TOP04 on stored pages: the rows of a hash range, from the files whose ranges meet it."""
    listed = spark.read.schema(FILES).parquet(f"{path}/files").where((F.col("high.row_hash") >= low) & (F.col("low.row_hash") <= high))
    return _page(spark, path, [row["file"] for row in listed.select("file").toLocalIterator()], None).where(F.col("row_hash").between(low, high))


def _page(spark: SparkSession, path: str, files: Sequence[str], start) -> DataFrame:
    schema = spark.read.parquet(f"{path}/rows").schema
    if not files:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(*files)
    return rows if start is None else rows.where(F.struct(F.col("row_hash").cast("long").alias("row_hash"), F.col("occ").cast("int").alias("occ")) > start)
