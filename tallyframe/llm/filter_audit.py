"""Filter interaction audit (operator 13).

Method: exact constrained least squares. What each coalition of filters removes is tabulated; the Shapley
values of the filters are the solution of the kernel-weighted least-squares problem over all coalitions whose
values must add up to what all filters remove. Its normal equations are solved in rationals, once, for the
values of all coalitions at a time, so each part of the data needs one exact linear form of its table.
What a step of a chain of filters does is the difference of two coalitions.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import cut_lineage

WORDS = "[\\x20\\x09-\\x0D]+"


def words_of(text: Column) -> Column:
    """The maximal runs of characters other than space and 09 to 0D."""
    return F.array_remove(F.split(text, WORDS), "")


#: Failure conditions by letter, over columns ``text`` and ``words``. None: the text is that of a row of smaller doc_id.
FILTERS: Mapping[str, Callable[[Column, Column], Column] | None] = {
    "A": lambda text, words: F.size(words) < 200,
    "B": lambda text, words: 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
    "C": lambda text, words: 100 * F.regexp_count(text, F.lit("[A-Z]")) > 2 * F.char_length(text),
    "D": lambda text, words: F.rlike(text, F.lit("[#$%&*|]")),
    "E": None,
}


def shapley_forms(n: int) -> list[list[Fraction]]:
    """Row f: the Shapley value of filter f as a linear form of the values of all 2 ** n coalitions.

    They minimise sum(weight(S) * (value(S) - sum of S's own) ** 2) over proper coalitions, with weight
    (n - 1) / (comb(n, s) * s * (n - s)), where all values together are that of the whole. Elimination by
    pivots on the normal equations, with one multiplier for the constraint and a right side per coalition."""
    whole = (1 << n) - 1
    rows = [[Fraction(0)] * (n + 1 + whole + 1) for _ in range(n + 1)]
    for coalition in range(1, whole):
        inside = [i for i in range(n) if coalition >> i & 1]
        weight = Fraction(n - 1, comb(n, len(inside)) * len(inside) * (n - len(inside)))
        for i in inside:
            rows[i][n + 1 + coalition] += weight
            for j in inside:
                rows[i][j] += weight
    for i in range(n):
        rows[i][n] = rows[n][i] = Fraction(1)
    rows[n][n + 1 + whole] = Fraction(1)
    for k in range(n + 1):
        pivot = next(i for i in range(k, n + 1) if rows[i][k])
        rows[k], rows[pivot] = rows[pivot], rows[k]
        rows[k] = [x / rows[k][k] for x in rows[k]]
        for i in range(n + 1):
            if i != k and rows[i][k]:
                rows[i] = [x - rows[i][k] * y for x, y in zip(rows[i], rows[k], strict=True)]
    return [row[n + 1 :] for row in rows[:n]]


def failures(documents: DataFrame, filters: Mapping = FILTERS, part: str = "source") -> DataFrame:
    """part, doc_id, mask and n: how many rows of a doc_id fail which filters (bit k: the k-th one). Whole texts are
    read once and only their digests go on; rows that agree in all of this are one from there."""
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    read = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), text)
    read = read.withColumn("words", words_of(F.col("text")))
    own = [F.when(fails(F.col("text"), F.col("words")), 1 << k).otherwise(0) for k, fails in enumerate(filters.values()) if fails]
    mask = sum(own, F.lit(0)).alias("mask")
    counted = read.select("part", "doc_id", F.unhex(F.sha2("text", 256)).alias("digest"), mask).groupBy("digest", "doc_id", "part", "mask").agg(F.count("*").alias("n"))
    repeats = [1 << k for k, fails in enumerate(filters.values()) if fails is None]
    if not repeats:
        return counted.select("part", "doc_id", "mask", "n")
    counted = cut_lineage(counted)
    # a text's first row is found by a grouped minimum and met by text and id, which no group of copies shares
    first = counted.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).select(F.col("digest").alias("d"), F.col("doc_id").alias("id"), F.lit(True).alias("first"))
    met = counted.join(first, (F.col("digest") == F.col("d")) & F.col("doc_id").eqNullSafe(F.col("id")), "left")
    return met.select("part", "doc_id", (F.col("mask") + F.when(F.col("first"), 0).otherwise(sum(repeats))).alias("mask"), "n")


def tabulated(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: rows that fail just the filters of a mask, and how many of them are labelled so."""
    one = lambda c: F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(c)
    of = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(one("quality"), one("toxic")).where("quality or toxic").withColumn("named", F.lit(True))
    # rows without an id have no label; they are dealt out by what they hold
    keyed = rows.withColumn("key", F.coalesce(F.col("doc_id"), F.xxhash64("part", "mask", "n"))).withColumn("has", F.col("doc_id").isNotNull())
    both = keyed.join(of, (F.col("key") == F.col("label_id")) & (F.col("has") == F.col("named")), "left")
    counts = [F.sum("n").alias("n"), *[F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(name) for c, name in (("quality", "good"), ("toxic", "toxic"))]]
    return both.groupBy("part", "mask").agg(*counts)


def filter_audit(documents: DataFrame, labels: DataFrame, filters: Mapping = FILTERS, part: str = "source") -> DataFrame:
    """What each filter removes in every order: part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost and shapley, one row per part, order and step.

    A part is a value of ``part`` (null: the empty text). Counts are of rows of the part: kept after the step,
    removed by it, redundant (failing its filter, removed earlier), unique_fails (failing its filter alone), good and
    toxic ones among the removed. shapley: the filter's removals summed over all orders.

    A null text is an empty one. Of rows with equal texts those of the smallest doc_id are no repeats; a null id is
    beyond all others, and rows that have null ids only are no repeats. Repeated rows count each. A doc_id is good (toxic)
    if any of its labels says 1; null ids have no labels. Other columns are not read, whatever their names. No rows
    give no rows. Texts are equal where their SHA-256 is."""
    names = list(filters)
    size = 1 << len(names)
    forms = [[x * factorial(len(names)) for x in form] for form in shapley_forms(len(names))]
    assert all(x.denominator == 1 for form in forms for x in form)

    table = tabulated(failures(documents, filters, part), labels)
    # at most 2 ** filters masks to a part
    table = table.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"), F.sum("n").alias("total"))
    coalitions = F.sequence(F.lit(0), F.lit(size - 1))
    hit = lambda c, x, s: F.when(x["mask"].bitwiseAND(s) != 0, x[c]).otherwise(F.lit(0).cast("long"))
    lost = lambda c: F.transform(coalitions, lambda s: F.aggregate("cells", F.lit(0).cast("long"), lambda total, x: total + hit(c, x, s)))
    table = table.select("part", "total", lost("n").alias("removals"), lost("good").alias("good"), lost("toxic").alias("toxic"))
    dot = lambda form: F.aggregate(F.zip_with("removals", F.array(*[F.lit(int(x)).cast("long") for x in form]), lambda a, b: a * b), F.lit(0).cast("long"), lambda a, b: a + b)
    table = table.withColumn("shares", F.array(*[dot(form) for form in forms]))

    orders = F.array(*[F.lit("".join(p)) for p in permutations(names)])
    steps = table.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(names)))))
    earlier = F.substring("filter_order", F.lit(1), F.col("step") - 1)
    before = sum((F.when(F.contains(earlier, F.lit(name)), 1 << k).otherwise(0) for k, name in enumerate(names)), F.lit(0))
    number = F.instr(F.lit("".join(names)), F.substring("filter_order", F.col("step"), F.lit(1))) - 1
    steps = steps.withColumn("before", before).withColumn("number", number).withColumn("own", F.expr("shiftleft(1, number)"))
    at = lambda c, s: F.get(F.col(c), s)
    after = F.col("before").bitwiseOR(F.col("own"))
    step = lambda c: at(c, after) - at(c, F.col("before"))
    return steps.select(
        "part", "filter_order", "step",
        (F.col("total") - at("removals", after)).alias("kept"),
        step("removals").alias("removed"),
        (at("removals", F.col("own")) - step("removals")).alias("redundant"),
        (at("removals", F.lit(size - 1)) - at("removals", F.lit(size - 1).bitwiseXOR(F.col("own")))).alias("unique_fails"),
        step("good").alias("good_lost"), step("toxic").alias("toxic_lost"),
        F.get(F.col("shares"), F.col("number")).alias("shapley"),
    )
