"""Mixing sources to target weights (operator 4), with DataFrame functions only.

Method: pivotal dependent rounding. Every document of a source is to be taken target / source_size times;
the whole part is certain, the fraction is settled in pairs: words move at random from one of two
documents to the other, up or down with the chances that keep both fractions' means, until one of them is
0 or 1. The words in a pair don't change, so a source's words come to its target but for the last, single
document. Blocks of a source settle on their own and each leaves one unsettled document; those are settled
in blocks again, and so on: a tree of reductions whose height is the logarithm of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tallyframe.llm.common import cut_lineage, row_hash, whole
from tallyframe.llm.sharding import numbered

#: Documents settled in one row: blocks have about so many, whatever a source's size.
BLOCK = 128
#: Rows of one doc_id, source and size that are numbered in one task, about; copies of a row in one list.
SALTED = 1 << 15
#: Sources at most: the windows over them hold a row for each.
SOURCES = 1 << 20
#: Targets that are broadcast, at most (with names of 64 bytes on average), and tasks for a source's rows where there are more.
FEW, SALTS = 1 << 14, 64
#: Fixed value: a word is a run of characters other than these.
WORD = r"[^\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2) -> DataFrame:
    """sid, source, source_size, n_rows, target for each source of ``sizes`` (source, source_size, n_rows).

    Sources by code point, nulls last, weigh ``weights``, repeating, and share ``share`` times all words;
    a target stops at ``most`` times its source's words, and the excess is shared by weight again. That
    is one water level: in order of cap / weight, the first source that the level of the rest doesn't
    reach sets it for all after it. One row per source, of which there may be SOURCES, so its windows may be
    global."""
    everything = Window.partitionBy()
    ranked = sizes.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("sid") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    ranked = ranked.withColumn("at", F.row_number().over(Window.orderBy(F.col("cap") / F.col("weight"), "sid")))
    before = Window.orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    level = (share * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    ranked = ranked.withColumn("level", level)
    first = F.min(F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.struct("at", "level"))).over(everything)
    target = F.least(F.col("cap").cast("double"), F.coalesce(first["level"] * F.col("weight"), F.col("cap").cast("double")))
    return ranked.withColumn("target", target).select("sid", "source", "source_size", "n_rows", "target")


def chance(*keys: Column | str, seed: int) -> Column:
    """A number from 0 to 1 that keys and seed decide."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *keys), 11) / F.lit(float(1 << 53))


def settled(items: Column) -> Column:
    """Pivotal rounding of an array of structs with p (fraction), w (words) and u (chance).

    Gives bits, a struct (i, bit) for each item but one, and that one's position ri and fraction rp."""
    start = F.struct(F.lit(0).alias("k"), F.lit(-1).alias("ri"), F.lit(0.0).alias("rp"), F.lit(0.0).alias("rw"), F.array().cast("array<struct<i:int,bit:int>>").alias("bits"))

    def step(acc: Column, e: Column) -> Column:
        up_r, up_e, down_r, down_e = (1 - acc["rp"]) * acc["rw"], e["p"] * e["w"], acc["rp"] * acc["rw"], (1 - e["p"]) * e["w"]
        a, b = F.least(up_r, up_e), F.least(down_r, down_e)
        # words move to the first one (up) or from it; either way the one that can take or give less is settled
        up = e["u"] * (a + b) < b
        first = F.when(up, up_r <= up_e).otherwise(down_r <= down_e)
        bit = F.when(up == first, 1).otherwise(0)
        left = F.when(first, F.when(up, e["p"] - a / e["w"]).otherwise(e["p"] + b / e["w"])).otherwise(F.when(up, acc["rp"] + a / acc["rw"]).otherwise(acc["rp"] - b / acc["rw"]))
        alone = acc["ri"] < 0
        moves = ~alone & ~first
        return F.struct(
            (acc["k"] + 1).alias("k"),
            F.when(moves, acc["ri"]).otherwise(acc["k"]).alias("ri"),
            F.when(alone, e["p"]).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), left))).alias("rp"),
            F.when(moves, acc["rw"]).otherwise(e["w"]).alias("rw"),
            F.when(alone, acc["bits"]).otherwise(F.concat(acc["bits"], F.array(F.struct(F.when(first, acc["ri"]).otherwise(acc["k"]).alias("i"), bit.alias("bit"))))).alias("bits"),
        )

    return F.aggregate(items, start, step)


def tree(leaves: DataFrame, blocks: int, seed: int) -> DataFrame:
    """sid, block, bit: the rounding of each block's unsettled document (``leaves``: sid, block, p, w)."""
    levels, nodes = [], leaves
    while blocks > 1:
        blocks = -(-blocks // BLOCK)
        item = F.struct(chance("sid", "block", seed=seed + len(levels) + 1).alias("u"), "block", "p", "w")
        grouped = nodes.groupBy("sid", F.floor(F.col("block") / BLOCK).alias("above")).agg(F.sort_array(F.collect_list(item)).alias("items"))
        level = cut_lineage(grouped.withColumn("out", settled(F.col("items"))))
        levels.append(level)
        nodes = level.select("sid", F.col("above").alias("block"), F.col("out.rp").alias("p"), F.col("out.rw").alias("w"))
    decided = nodes.select("sid", "block", (chance("sid", "block", seed=seed) < F.col("p")).cast("int").alias("bit"))
    for level in reversed(levels):
        own = level.join(decided.withColumnRenamed("block", "above"), ["sid", "above"])
        bits = F.concat("out.bits", F.array(F.struct(F.col("out.ri").alias("i"), F.col("bit"))))
        decided = own.select("sid", "items", F.explode(bits).alias("x")).select("sid", F.expr("items[x.i].block").alias("block"), F.col("x.bit").alias("bit"))
    return decided


def mixed(documents: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2, seed: int = 11) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies and source of each row.

    size: words of the whole text (null: 0); target: the words its source is to give (see
    ``source_targets``); taken: copies * size. A source's sum of taken differs from its target by less
    than one document's words, and no document is taken more than ``most`` times.

    A null source is a source of its own, last in order; a null doc_id is an id like others; rows that
    repeat id, source and size are settled one by one; rows without words are taken 0 words and copied by
    chance; other columns are not read, whatever their names; no rows give no rows. Reruns agree: only
    the rows and the seed decide."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "source", words_of(F.col("text")).alias("size"))
    counted = cut_lineage(rows.groupBy("doc_id", "source", "size").agg(F.count("*").alias("n")))
    sizes = counted.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n_rows"))
    sizes = cut_lineage(sizes)
    if sizes.count() > SOURCES:
        raise ValueError(f"more than {SOURCES} sources")
    targets = cut_lineage(source_targets(sizes, weights, share, most))
    least = targets.agg(F.count("*"), F.sum(F.octet_length("source"))).first()
    few = least[0] <= FEW and (least[1] or 0) <= FEW * 64
    single = with_targets(numbered(counted, "rep"), targets, "source", few)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    single = single.withColumn("ratio", ratio).withColumn("sure", F.floor("ratio").cast("long")).withColumn("p", F.col("ratio") - F.floor("ratio"))
    single = single.withColumn("u", chance("doc_id", "rep", "size", seed=seed))
    columns = ["doc_id", "size", "source_size", "target", "source", "copies"]

    open_ = (F.col("size") > 0) & (F.col("p") > 0)
    certain = single.where(~open_).withColumn("copies", F.col("sure") + (F.col("u") < F.col("p")).cast("long"))
    block = F.pmod(F.xxhash64(F.lit(seed), "rep", "doc_id", "size"), F.ceil(F.col("n_rows") / BLOCK))
    item = F.struct(F.xxhash64("doc_id", "rep", F.lit(seed)).alias("order"), "doc_id", "rep", "size", F.col("size").cast("double").alias("w"), "p", "u")
    grouped = single.where(open_).groupBy("sid", block.alias("block")).agg(F.sort_array(F.collect_list(item)).alias("items"))
    leaves = cut_lineage(grouped.withColumn("out", settled(F.col("items"))))
    most_blocks = targets.agg(F.max(F.ceil(F.col("n_rows") / BLOCK))).first()[0] or 0
    bits = tree(leaves.select("sid", "block", F.col("out.rp").alias("p"), F.col("out.rw").alias("w")), most_blocks, seed)
    done = leaves.join(bits, ["sid", "block"])
    every = F.sort_array(F.concat("out.bits", F.array(F.struct(F.col("out.ri").alias("i"), F.col("bit")))))
    done = done.select("sid", F.explode(F.arrays_zip("items", every.alias("bits"))).alias("x")).select("sid", "x.items.doc_id", "x.items.size", "x.bits.bit")
    done = with_targets(done, targets, "sid", few).withColumn("copies", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long") + F.col("bit"))
    out = certain.select(*columns).union(done.select(*columns))
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "source")


def with_targets(rows: DataFrame, targets: DataFrame, key: str, few: bool) -> DataFrame:
    """Inner join of rows with their source's target, by ``source`` (null is one) or ``sid``. ``few`` targets, of a size that
    has been checked, are broadcast; more are dealt out SALTS times, so that a hot source's rows go to as many tasks."""
    other = targets.withColumnRenamed(key, "__key")
    if few:
        return rows.join(F.broadcast(other), rows[key].eqNullSafe(other["__key"])).drop("__key")
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64("doc_id", "size"), F.lit(SALTS)))
    other = other.withColumn("__other", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(other, salted[key].eqNullSafe(other["__key"]) & (F.col("__salt") == F.col("__other"))).drop("__key", "__salt", "__other")


def mix(documents: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2, seed: int = 11) -> DataFrame:
    """The rows that the mix takes, whole, each as often as it is taken. Reruns agree.

    Rows that share doc_id, source and words are told apart by a hash of all their columns (of types that
    can be hashed, so no maps), and get its decisions in order of salt and hash; equal rows are one row
    with a count, and are taken as often as all of them together. Nulls in doc_id and source are values like
    others; rows with an empty or null text have no words and are copied by chance; columns may have any
    names; no rows give no rows."""
    key = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(-(1 << 63))).alias("key")
    named = [key("doc_id"), "source", words_of(F.col("text")).alias("size"), row_hash(documents).alias("hash")]
    rows = cut_lineage(documents.select(*named).groupBy("key", "source", "size", "hash").agg(F.count("*").alias("n")))
    # salts grow with the rows, so that no group's part for one task does
    salts = (rows.agg(F.sum("n")).first()[0] or 0) // SALTED + 1
    rows = rows.withColumn("salt", F.pmod("hash", F.lit(salts)))
    # of rows alike, some are taken once more than the others: how many is all that their decisions say
    group = ["key", "source", "size"]
    decided = mixed(documents, weights, share, most, seed).groupBy(key("doc_id"), "source", "size")
    decided = decided.agg(F.min("copies").alias("low"), (F.sum("copies") - F.count("*") * F.min("copies")).alias("more"))
    parts = rows.groupBy(*group, "salt").agg(F.sum("n").alias("n"))
    parts = same(parts, decided, group).withColumn("more", portion(Window.partitionBy(*group).orderBy("salt")))
    own = same(rows, parts.drop("n"), [*group, "salt"]).withColumn("more", portion(Window.partitionBy(*group, "salt").orderBy("hash")))
    taken = cut_lineage(own.select("key", "hash", "n", (F.col("low") * F.col("n") + F.col("more")).alias("copies")).where("copies > 0"))

    single = documents if taken.where("n > 1").isEmpty() else documents.distinct()
    # many copies of one row are several lists of them
    pieces = taken.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / SALTED))))
    pieces = pieces.select("key", "hash", F.least(F.lit(SALTED), F.col("copies") - F.col("piece") * SALTED).alias("copies"))
    out = single.select(key("doc_id"), row_hash(single).alias("hash"), whole(single).alias("row")).join(pieces, ["key", "hash"])
    return out.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")


def same(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """Inner join on columns of which nulls are equal."""
    other = right.withColumnsRenamed({c: f"{c}_other" for c in columns})
    on = [left[c].eqNullSafe(other[f"{c}_other"]) for c in columns]
    return left.join(other, on).drop(*[f"{c}_other" for c in columns])


def portion(order: WindowSpec) -> Column:
    """What each row takes of ``more``, at most its ``n``, when rows are served in this order."""
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return F.greatest(F.lit(0).cast("long"), F.least(F.col("n"), F.col("more") - before))
