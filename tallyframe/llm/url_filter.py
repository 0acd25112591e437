"""URL filters (operator 1).

Method: sort-merge range join. A host's labels are reversed, so that a rule's host and all its subdomains
are one interval of keys; rules and urls are sorted by key together and swept once, with the rules whose
intervals the sweep is in on a stack. Intervals of hosts nest, so the stack is as deep as a host has
labels; each entry has the paths of one host.

Keys are dealt out by ranges of a bounded sample, with a hash behind the key, so that a host or url with
very many rows is cut into several ranges; a rule goes to each range that its interval meets.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.common import hash_sample, with_package
from tallyframe.llm.sharding import numbered

#: Sampled keys per range.
SAMPLE = 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased, and what
    follows up to ``?``, ``#`` or the end. Without ``://`` both are empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def reversed_host(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def rules_frame(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    """Rules (host, path, verdict) as rows."""
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


class ActiveRules:
    """The stack of the sweep: hosts whose intervals hold the present key, each with its paths and their lengths."""

    def __init__(self):
        self.stack: list[tuple[str, str, dict[str, str], list[int]]] = []

    def leave(self, key: str) -> None:
        while self.stack and self.stack[-1][0] <= key:
            self.stack.pop()

    def enter(self, end: str, host: str, path: str, verdict: str) -> None:
        if not self.stack or self.stack[-1][0] != end:
            self.stack.append((end, host, {}, []))
        paths, lengths = self.stack[-1][2:]
        at = bisect_left(lengths, len(path))
        if lengths[at : at + 1] != [len(path)]:
            lengths.insert(at, len(path))
        paths[path] = "block" if "block" in (verdict, paths.get(path)) else verdict

    def longest(self, path: str) -> tuple[str, str] | None:
        """Rule and verdict of the longest one that fits; of equally long ones that of the longer host."""
        best = None
        for _, host, paths, lengths in reversed(self.stack):
            if best is not None and len(host) + len(path) <= len(best[0]):
                continue
            for n in reversed(lengths[: bisect_right(lengths, len(path))]):
                verdict = paths.get(path[:n])
                if verdict is not None:
                    if best is None or len(host) + n > len(best[0]):
                        best = (host + path[:n], verdict)
                    break
        return best


def judged(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule and verdict of each url of ``pages``.

    A rule fits its host and all subdomains where the url's path starts with the rule's path; of those that
    fit, the longest (host and path) wins, and the verdict is its own. Urls that none fits get ``default``
    and a null rule. Rules that repeat host and path block if one of them does; rules with a null or an
    empty host are left out.

    A null url, or one without ``://``, has an empty host and path. Null page_ids stay; repeated rows give
    repeated rows; other columns are not read, whatever their names; no rows give no rows."""
    spark = pages.sparkSession
    with_package(spark)
    host, path = host_and_path(F.col("url"))
    # rows alike are one with their number, so that no key of the sweep is shared by very many
    counted = pages.select(F.col("page_id").cast("long").alias("page_id"), "url").groupBy("page_id", "url").agg(F.count("*").alias("n"))
    urls = counted.select("page_id", host.alias("h"), path.alias("p"), F.xxhash64("page_id", "url").alias("salt"), "n")
    urls = urls.select("page_id", F.coalesce("h", F.lit("")).alias("host"), F.coalesce("p", F.lit("")).alias("path"), "salt", "n")
    urls = urls.withColumn("key", F.concat(reversed_host(F.col("host")), F.lit(".")))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    sample = sorted((r.key, r.salt) for r in hash_sample(urls, SAMPLE * parts, "key", "salt").collect())
    # places among equal keys are dealt evenly over all salts
    edges: list[tuple[str, int]] = []
    for i in range(1, parts):
        at = i * len(sample) // parts
        if sample:
            key = sample[at][0]
            first, last = bisect_left(sample, (key,)), bisect_left(sample, (key + "\0",))
            edges.append((key, -(1 << 63) + (at - first) * (1 << 64) // (last - first)))
    cuts = sorted(set(edges))

    @F.pandas_udf("int")
    def range_of(key, salt):
        import pandas as pd

        return pd.Series([bisect_right(cuts, x) for x in zip(key, salt, strict=True)], dtype="int32")

    @F.pandas_udf("array<int>")
    def ranges_of(start, end):
        import pandas as pd

        least = -(1 << 63)
        return pd.Series([list(range(bisect_right(cuts, (a, least)), bisect_left(cuts, (b, least)) + 1)) for a, b in zip(start, end, strict=True)])

    known = rules.where("host is not null and host != '' and path is not null and verdict is not null").select(F.translate("host", _UPPER, _LOWER).alias("host"), "path", "verdict")
    known = known.withColumn("key", F.concat(reversed_host(F.col("host")), F.lit("."))).withColumn("end", F.concat(reversed_host(F.col("host")), F.lit("/")))
    known = known.withColumn("part", F.explode(ranges_of("key", "end")))
    columns = ["part", "key", "kind", "end", "host", "path", "verdict", "page_id", "n"]
    left = known.withColumn("kind", F.lit(0)).withColumn("page_id", F.lit(None).cast("long")).withColumn("n", F.lit(0).cast("long")).select(*columns)
    right = urls.withColumn("part", range_of("key", "salt")).withColumn("kind", F.lit(1)).withColumn("end", F.lit(None).cast("string")).withColumn("verdict", F.lit(None).cast("string")).select(*columns)
    merged = left.union(right).repartition("part").sortWithinPartitions("part", "key", "kind")

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, active = None, ActiveRules()
        for batch in batches:
            found: list[tuple] = []
            for at, key, kind, end, host, path, verdict, page_id, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != part:
                    part, active = at, ActiveRules()
                active.leave(key)
                if kind == 0:
                    active.enter(end, host, path, verdict)
                else:
                    found.append((page_id, n, host, path, *(active.longest(path) or (None, default))))
            columns = list(zip(*found, strict=True)) if found else [[]] * 6
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:2]), *(pa.array(c, pa.string()) for c in columns[2:])], names=["page_id", "n", "host", "path", "rule", "verdict"])

    out = merged.mapInArrow(sweep, "page_id long, n long, host string, path string, rule string, verdict string")
    return numbered(out, "copy").drop("copy")
