"""Sharding that keeps the mixture (operator 6).

Method: proportional stratified interleaving. Rows of each source are shuffled by a seeded hash and
ranked; a row's fractional rank (rank - 1/2) / rows of its source spreads every source evenly over 0 to
1; sorted by it, any stretch of rows has the sources in proportion, so equal cuts make the shards.

Both rankings are global and exact, yet no task ranks more than a bucket: a sort key's bucket is found
from the key alone, counts per bucket give each bucket's first rank, and a window ranks inside it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import cut_lineage, row_hash, whole

#: Rows of a bucket, about, and buckets at most: a window ranks all buckets of a group.
BUCKET, BUCKETS = 2_000, 1 << 20
#: Elements of a list from which rows are made, and rows of a shard's file.
LIST, FILE = 1 << 16, 1 << 20


def ranked(rows: DataFrame, group: list[str], bucket: Column, order: list, name: str) -> DataFrame:
    """``rows``, each standing for ``n`` rows, with ``name``: the ranks before its own within ``group`` by
    ``order``, and ``name``_of, the group's rows.

    ``bucket`` must not fall as ``order`` rises. Groups may hold nulls."""
    rows = rows.withColumn("bucket", bucket)
    counts = rows.groupBy(*group, "bucket").agg(F.sum("n").alias("n"))
    over = Window.partitionBy(*group)
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(*[F.col(c).alias(f"{c}_of") for c in group], F.col("bucket").alias("b"), before(over.orderBy("bucket")).alias("earlier"), F.sum("n").over(over).alias(f"{name}_of"))
    same = F.col("bucket") == F.col("b")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_of"))
    joined = rows.join(counts, same)
    inside = before(Window.partitionBy(*group, "bucket").orderBy(*order))
    return joined.withColumn(name, F.col("earlier") + inside).drop("bucket", "b", "earlier", *[f"{c}_of" for c in group])


def numbered(rows: DataFrame, name: str) -> DataFrame:
    """Each row ``n`` times, with ``name``: 1 to n. Lists of LIST elements make them."""
    lists = rows.withColumn("list", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / LIST))))
    element = F.explode(F.sequence(F.col("list") * LIST + 1, F.least(F.col("n"), (F.col("list") + 1) * LIST)))
    return lists.withColumn(name, element).drop("list", "n")


def sized(documents: DataFrame) -> list[Column]:
    text = F.coalesce("text", F.lit(""))
    return [F.col("doc_id").cast("long").alias("doc_id"), F.col("source"), (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32")]


def sharded(documents: DataFrame, shards: int = 16, seed: int = 7) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard and source of each row.

    The law is ``rows``: shards differ by one row at most, the first ones being longer. size: UTF-8 bytes
    of the text plus 1 (null: 1, and its crc is that of the empty text). slot counts a shard's rows from 0.

    A null source is a source of its own; a null doc_id is hashed as an empty one; rows that repeat id, source
    and text are ranked as one row with a count, and differ in nothing; other columns are not read,
    whatever their names; no rows give no rows."""
    rows = documents.select(*sized(documents))
    shuffled = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("text_crc32").cast("string")))
    rows = cut_lineage(rows.groupBy("doc_id", "source", "size", "text_crc32").agg(F.count("*").alias("n")).withColumn("h", shuffled))
    total = rows.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, min(BUCKETS, -(-total // BUCKET)))
    ties = ["h", F.col("doc_id").asc_nulls_first(), "text_crc32", "size"]
    by_hash = F.shiftright(F.conv(F.substring("h", 1, 8), 16, 10).cast("long") * buckets, 32)
    rows = numbered(ranked(rows, ["source"], by_hash, ties, "rank"), "copy")
    rows = rows.withColumn("at", (2 * (F.col("rank") + F.col("copy")) - 1) / (2 * F.col("rank_of"))).withColumn("n", F.lit(1).cast("long"))
    rows = ranked(rows, [], F.floor(F.col("at") * buckets), ["at", *ties, F.col("source").asc_nulls_first()], "place")
    least, longer = divmod(total, shards)
    place = F.col("place")
    edge = longer * (least + 1)
    in_long, in_short = F.floor(place / (least + 1)), longer + F.floor((place - edge) / max(1, least))
    rows = rows.withColumn("shard", F.when(place < edge, in_long).otherwise(in_short).cast("int"))
    slot = place - F.col("shard") * least - F.least(F.col("shard"), F.lit(longer))
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "source")


def write_shards(documents: DataFrame, path: str, shards: int = 16, seed: int = 7) -> None:
    """Write whole rows as Parquet: a folder ``shard=k`` each, and in it one ``file=f`` for each FILE slots, in slot order.

    Rows that share doc_id, source, size and crc get their slots in order of a hash of all their columns (of types that
    can be hashed, so no maps); equal rows are one row with a count. Null ids and sources, empty and null texts are
    rows like others; no rows give no files but the folder. ``documents`` must not have columns ``shard`` or ``file``."""
    keys = ["doc_id", "source", "size", "text_crc32"]
    number = Window.partitionBy(*keys).orderBy("hash")
    counted = cut_lineage(documents.select(*sized(documents), row_hash(documents).alias("hash")).groupBy(*keys, "hash").agg(F.count("*").alias("n")))
    before = F.coalesce(F.sum("n").over(number.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    own = numbered(counted.withColumn("before", before), "copy").withColumn("at", F.col("before") + F.col("copy")).drop("before", "copy")
    slots = sharded(documents, shards, seed).select(*keys, "shard", "slot")
    slots = slots.withColumn("slot_at", F.row_number().over(Window.partitionBy(*keys).orderBy("shard", "slot"))).withColumnsRenamed({c: f"slot_{c}" for c in keys})
    meet = F.col("at") == F.col("slot_at")
    for c in keys:
        meet = meet & F.col(c).eqNullSafe(F.col(f"slot_{c}"))
    placed = own.join(slots, meet).select("hash", "shard", "slot", F.floor(F.col("slot") / FILE).alias("file"))
    single = documents if counted.where("n > 1").isEmpty() else documents.distinct()
    rows = single.select(row_hash(single).alias("hash"), whole(single).alias("row")).join(placed, "hash")
    rows = rows.repartition("shard", "file").sortWithinPartitions("shard", "file", "slot").select("row.*", "shard", "file")
    rows.write.partitionBy("shard", "file").parquet(path)
