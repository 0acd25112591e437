"""Helpers that several operators share: checkpoints, byte-bounded Arrow slices, id bitmaps, words."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.workers import cut_lineage, remove_folder, shared_folder, ship_package

#: Bytes of text and rows that a task works on at once.
SLICE_BYTES, SLICE_ROWS = 1 << 20, 512
#: Bits of an id bitmap: 8 MiB whatever the input, so that it may be broadcast.
BITMAP_BITS = 1 << 26

U64 = np.uint64


class Scratch:
    """Tables of one computation in the shared folder, which go when it is over.

    Unlike a checkpoint, a table's size is known as it is, while a checkpoint keeps its plan's estimate: a product of
    sizes for each join, which in loops grows until planning takes longer than the work. Empty parts write no file."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.folder, self.tables = spark, f"{shared_folder(spark)}/scratch-{uuid.uuid4()}", 0

    def __call__(self, df: DataFrame) -> DataFrame:
        self.tables += 1
        path = f"{self.folder}/{self.tables}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        """Remove the tables: whatever is read later must have been written elsewhere."""
        remove_folder(self.spark, self.folder)


def give_back() -> None:
    """Return this process's free memory to the system: what NumPy and Arrow freed stays with their allocators otherwise,
    and a worker waits for its next task with all that its largest one took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def tidy(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` on a task's batches, with ``give_back`` when the task is over."""

    def tidied(batches: Iterator) -> Iterator:
        try:
            yield from work(batches)
        finally:
            give_back()

    return tidied


def with_package(spark: SparkSession) -> None:
    """Send this package to workers that don't have it."""
    ship_package(spark)


def quoted(name: str) -> str:
    """A column's name for Spark, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def whole(df: DataFrame) -> Column:
    """A row as one struct: names beside it can't clash with the row's own."""
    return F.struct(*[F.col(quoted(c)) for c in df.columns])


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns of types that can be hashed (no maps). Nulls count, each in its place."""
    named = [F.col(quoted(f.name)) for f in df.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    return F.xxhash64(*named, *[c.isNull() for c in named])


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def hash_sample(df: DataFrame, n: int, *columns: str) -> DataFrame:
    """About n distinct rows of these columns, or all if there are fewer, chosen by their hash: reruns agree,
    and what tasks send is n rows in all, not each."""
    share = min(1.0, n / max(1, df.count()))
    place = F.shiftrightunsigned(F.xxhash64(F.lit(17), *columns), 11) / F.lit(float(1 << 53))
    return df.select(*columns).where(place < share).distinct()


def text_slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of a batch of about ``limit`` bytes of text (one row at least) and SLICE_ROWS rows at most, each with the
    bytes of its texts, end to end, and the n + 1 offsets of the rows in them. A null text is an empty one."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        base = ends[at - 1] if at else 0
        to = min(at + SLICE_ROWS, max(at + 1, int(np.searchsorted(ends, base + limit, "right"))))
        part = batch.slice(at, to - at)
        texts = pc.fill_null(part.column(column).cast(pa.large_binary()), b"")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] > offsets[0] else np.empty(0, np.uint8)
        yield part, data, (offsets - offsets[0]).astype(np.int64)
        at = to


def texts_of(data: np.ndarray, offsets: np.ndarray) -> list[str]:
    """The texts of a part that ``text_slices`` gives."""
    raw = data.tobytes()
    return [raw[i:j].decode() for i, j in zip(offsets.tolist(), offsets[1:].tolist(), strict=False)]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), for whole arrays."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_RADIX = 0x9E3779B97F4A7C15 | 1
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * U64(0xD1342543DE82EF95))
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd number modulo 2**64, and of its inverse."""
    if len(_powers.get("up", ())) < n:
        size = max(n, SLICE_BYTES + 1024)
        for name, radix in (("up", _RADIX), ("down", pow(_RADIX, -1, 1 << 64))):
            out = np.full(size, radix, U64)
            out[0] = 1
            _powers[name] = np.multiply.accumulate(out)
    return _powers["up"][:n], _powers["down"][:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Sums of byte codes times powers, before each position: hashes of all windows follow by subtraction."""
    out = np.zeros(len(data) + 1, U64)
    np.cumsum(_BYTE[data] * powers(len(data))[0], out=out[1:])
    return out


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of each word (a run of bytes other than space and 09 to 0D) and the n + 1
    word offsets of the rows. ``lower``: A-Z count as a-z."""
    if not len(data):
        empty = np.empty(0, np.int64)
        return np.empty(0, U64), empty, empty, np.zeros(len(offsets), np.int64)
    if lower:
        data = _LOWER[data]
    gap = _SEPARATOR[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = edge[:-1].copy()
    before[1:] |= gap[:-1]
    after = edge[1:].copy()
    after[:-1] |= gap[1:]
    start = np.flatnonzero(before & ~gap)
    end = np.flatnonzero(after & ~gap) + 1
    sums = prefix_hash(data)
    hashes = mix((sums[end] - sums[start]) * powers(len(data))[1][start] + (end - start).astype(U64))
    return hashes, start, end, np.searchsorted(start, offsets)


def id_bitmap(hashes: DataFrame, column: str) -> np.ndarray:
    """Bits of a column's hashes (64-bit numbers), as 8 MiB of bytes for any number of them.

    It lets through all of them and, once there are many, some others: a filter in front of an exact
    join, which thereby shuffles fewer rows. Only these 2,048 blocks come to the driver."""
    blocks = (
        hashes.select((F.pmod(column, F.lit(BITMAP_BITS)) + 1).alias("spot"))
        .groupBy(F.bitmap_bucket_number("spot").alias("block"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("bits"))
        .collect()
    )
    out = np.zeros(BITMAP_BITS // 8, np.uint8)
    size = 4096
    for row in blocks:
        part = np.frombuffer(bytes(row.bits), np.uint8)
        out[(row.block - 1) * size : (row.block - 1) * size + len(part)] = part
    return out


def in_bitmap(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes.astype(np.int64) % BITMAP_BITS
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def matched_rows(df: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """``left_semi`` or ``left_anti`` join of wide rows with ``rows`` (row: their ``row_hash``) that shuffles few
    of the wide rows.

    Rows whose hash is not in the bitmap of ``rows`` surely have no match and stay where they are; the others
    go through an exact join."""
    spark = df.sparkSession
    with_package(spark)
    bits = spark.sparkContext.broadcast(id_bitmap(rows, "row"))

    @F.pandas_udf("boolean")
    def maybe(hashes):
        import pandas as pd

        return pd.Series(in_bitmap(bits.value, hashes.to_numpy()))

    flagged = df.select(row_hash(df).alias("row"), whole(df).alias("whole")).withColumn("maybe", maybe("row"))
    out = flagged.where("maybe").join(rows.select("row").distinct(), "row", how).select("whole.*")
    return out if how == "left_semi" else out.unionByName(flagged.where("not maybe").select("whole.*"))
