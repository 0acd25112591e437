"""Secrets in texts (operator 8), with DataFrame functions only.

Method: multipart credential linking. Strong matches (assignments to secret names, access key ids, long
hex) are reported by themselves. Weak ones - account names, random-looking strings, endpoints - are
common in clean text, so they are interval-joined with the other parts of a credential: each part's
span is widened by a scope, and a weak part counts only where it meets the parts that complete it. All
parts of a credential stand in one text, so the join runs within a row; texts are not shuffled.

The join is a sorted sweep: parts in order of their starts, with the furthest end so far of the parts to be
met, and the nearest start to come. So its work grows with the parts, not with their pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import whole

# The patterns of strong matches. Of the assignments, those with too short a value go
# after matching, so that their text is not matched again.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LEAST_VALUE = 6
# Patterns of weak parts.
ACCOUNT = r"""(?i)(?<![a-z0-9_])(?:user(?:_?name)?|login|client_?id|account_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?[a-z0-9@._+-]{3,}"""
# A random-looking string also has a digit and a letter, wherever they are in it.
RANDOM = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}"
ENDPOINT = r"""(?:https?|postgres(?:ql)?|mysql|mongodb|redis|amqps?|s3|ftp)://[^\x20\x09-\x0D"'<>]+"""

#: In the order in which kinds at one start are listed.
KINDS = ("assign", "access", "hex", "account", "random", "endpoint")
STRONG = KINDS[:3]
#: Characters between two parts of one credential, at most.
SCOPE = 300
#: Values that are folded one by one; longer arrays are folded by parts of so many.
PART = 256
#: Code points of a text to a piece, from which stretches of it are cut.
PIECE = 256

_SPANS = "array<struct<start:int,kind:int,end:int>>"
_FAR = 1 << 30
_later, _sooner = (lambda a, x: F.greatest(a, x)), (lambda a, x: F.least(a, x))


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, also where ``use`` needs it in a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(values: Column, start: int, join) -> Column:
    """``join`` of ``start`` and an array's ints up to each. By parts, so that the work doesn't grow with the
    square of the length: a long text may have a hundred thousand matches."""
    fold = lambda xs: F.aggregate(xs, F.lit(start), join)
    last = F.greatest(F.lit(0), F.ceil(F.size(values) / PART).cast("int") - 1)
    cut = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(values, k * PART + 1, F.lit(PART)))
    inside = lambda part, before: F.transform(part, lambda _, i: join(before, fold(F.slice(part, F.lit(1), i + 1))))

    def with_parts(parts: Column) -> Column:
        folds = F.transform(parts, fold)
        before = bound(folds, lambda t: F.transform(t, lambda _, k: fold(F.slice(t, F.lit(1), k))))
        return bound(before, lambda o: F.flatten(F.transform(parts, lambda part, k: inside(part, F.get(o, k)))))

    return bound(cut, with_parts)


def spans(text: Column, pattern: str, kind: str, keep=None, group: int = 0) -> Column:
    """Start, kind and end of the pattern's matches, in code points. The text between matches and the
    matches give the positions. ``keep``: which matches stay, told by the text of ``group``."""
    p = F.lit(pattern)
    sizes = lambda strings: F.transform(strings, F.length)
    kept = F.transform(F.regexp_extract_all(text, p, F.lit(group)), keep) if keep else None

    def made(whole: Column, between: Column) -> Column:
        lengths = F.zip_with(whole, F.slice(between, F.lit(1), F.size(whole)), lambda m, b: m + b)
        ends = running(lengths, 0, lambda a, x: a + x)
        if kept is None:
            return F.zip_with(whole, ends, lambda m, end: F.struct((end - m).alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.alias("end")))
        rows = F.filter(F.arrays_zip(whole.alias("m"), ends.alias("end"), kept.alias("stays")), lambda x: x["stays"])
        return F.transform(rows, lambda x: F.struct((x["end"] - x["m"]).alias("start"), F.lit(KINDS.index(kind)).alias("kind"), x["end"].alias("end")))

    found = bound(sizes(F.regexp_extract_all(text, p, F.lit(0))), lambda w: bound(sizes(F.split(text, pattern, -1)), lambda b: made(w, b)))
    return F.when(F.rlike(text, p), found).otherwise(F.array().cast(_SPANS))


def _equals(number: int):
    return lambda x: x == number


def of_kinds(x: Column, *kinds: str) -> Column:
    return x["kind"].isin([KINDS.index(k) for k in kinds])


def with_met(rows: DataFrame, scope: int, **others) -> DataFrame:
    """``rows`` with a column of flags by each name: for each of the sorted spans in ``every``, whether one for
    which the function of that name holds is within ``scope`` characters.

    Of those that start no later, the furthest end decides, of the others the nearest start."""
    every = F.col("every")

    def furthest(holds) -> Column:
        return running(F.transform(every, lambda x: F.when(holds(x), x["end"]).otherwise(-_FAR)), -_FAR, _later)

    def nearest(holds) -> Column:
        return F.reverse(running(F.reverse(F.transform(every, lambda x: F.when(holds(x), x["start"]).otherwise(_FAR))), _FAR, _sooner))

    def met(name: str) -> Column:
        # zipped, since a column named inside a lambda may be computed there for each element
        rows = F.arrays_zip(every.alias("x"), F.col(f"{name}_end").alias("end"), F.col(f"{name}_start").alias("start"))
        return F.transform(rows, lambda r: (r["end"] >= r["x"]["start"] - scope) | (r["start"] <= r["x"]["end"] + scope))

    sums = {f"{name}_end": furthest(holds) for name, holds in others.items()} | {f"{name}_start": nearest(holds) for name, holds in others.items()}
    return rows.withColumns(sums).withColumns({name: met(name) for name in others}).drop(*sums)


def with_spans(rows: DataFrame, scope: int) -> DataFrame:
    """``rows`` (row, text) with strong spans (``base``) and all that are reported (``spans``), by start and kind.

    A random-looking string is reported if an identifier (access id or account) is in its scope; an
    account, if a secret (assignment, hex or random-looking string) is; an endpoint, if both are. Accounts and
    random-looking strings that share a character with a strong span are left out: it is reported already."""
    text = F.col("text")
    long = lambda value: F.length(value) >= LEAST_VALUE
    mixed = lambda value: F.rlike(value, F.lit("[0-9]")) & F.rlike(value, F.lit("[A-Za-z]"))
    rows = rows.withColumns({"assign": spans(text, ASSIGN, "assign", long, 2), "access": spans(text, ACCESS, "access"), "hex": spans(text, HEX, "hex")})
    rows = rows.withColumn("base", F.sort_array(F.concat("assign", "access", "hex")))
    named = (F.size("access") > 0) | F.rlike(text, F.lit(ACCOUNT))
    secret = (F.size("assign") + F.size("hex") > 0) | F.rlike(text, F.lit(RANDOM))
    rows = rows.withColumn("linked", named & secret).drop("assign", "access", "hex")
    weak = F.concat(spans(text, ACCOUNT, "account"), spans(text, RANDOM, "random", mixed), spans(text, ENDPOINT, "endpoint"))
    rows = rows.withColumn("weak", F.when(F.col("linked"), weak).otherwise(F.array().cast(_SPANS)))
    # texts without weak parts are done
    rows = rows.withColumn("every", F.when(F.size("weak") > 0, F.sort_array(F.concat("base", "weak"))).otherwise(F.array().cast(_SPANS)))
    rows = with_met(rows, -1, covered=lambda x: of_kinds(x, *STRONG))
    free = F.filter(F.arrays_zip(F.col("every").alias("x"), "covered"), lambda r: ~(of_kinds(r["x"], "account", "random") & r["covered"]))
    rows = rows.withColumn("every", F.transform(free, lambda r: r["x"])).drop("covered")
    rows = with_met(rows, scope, id=lambda x: of_kinds(x, "access", "account"), key=lambda x: of_kinds(x, "assign", "hex", "random"))

    def stays(r: Column) -> Column:
        return F.when(of_kinds(r["x"], "random"), r["id"]).when(of_kinds(r["x"], "account"), r["key"]).when(of_kinds(r["x"], "endpoint"), r["id"] & r["key"]).otherwise(True)

    kept = F.transform(F.filter(F.arrays_zip(F.col("every").alias("x"), "id", "key"), stays), lambda r: r["x"])
    rows = rows.withColumn("spans", F.when(F.size("weak") > 0, kept).otherwise(F.col("base")))
    return rows.select("row", "text", "base", "spans")


def listed(array: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(array, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def secrets(documents: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base (strong spans) and spans (all reported) of each whole text.

    Spans are kind:start:end in code points, end exclusive, by start and then kind, joined by commas.

    A null or empty text has none (empty strings, zeros); a null doc_id stays; repeated rows give repeated
    rows; other columns are not read, whatever their names; no rows give no rows. There is no shuffle."""
    rows = documents.select(F.col("doc_id").cast("long").alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    found = with_spans(rows, scope)
    count = [F.size(F.filter(F.transform("base", lambda x: x["kind"]), _equals(i))).cast("long").alias(f"n_{name}") for i, name in enumerate(STRONG)]
    return found.select(F.col("row").alias("doc_id"), *count, listed(F.col("base")).alias("base"), listed(F.col("spans")).alias("spans"))


def masked(rows: DataFrame, mask: str) -> DataFrame:
    """``rows`` (row, text, spans) with ``masked``: the text with each stretch of sorted spans replaced; spans that
    touch or overlap are one stretch.

    A span begins a stretch where it starts after all ends before it. What stands in between is cut from
    pieces of the text, so that no cut counts code points from the text's start."""
    pieces = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    ends = running(F.transform("spans", lambda x: x["end"]), 0, _later)
    rows = rows.withColumn("ends", ends)
    before = F.concat(F.array(F.lit(-1)), F.slice("ends", F.lit(1), F.greatest(F.lit(0), F.size("ends") - 1)))
    begun = F.filter(F.arrays_zip(F.col("spans").alias("x"), before.alias("at")), lambda r: r["x"]["start"] > r["at"])
    rows = rows.withColumn("begun", F.transform(begun, lambda r: F.struct(F.greatest(F.lit(0), r["at"]).alias("at"), r["x"]["start"].alias("to"))))
    # what follows the last stretch is one more cut
    tail = F.struct(F.element_at("ends", -1).alias("at"), F.length("text").alias("to"))
    rows = rows.withColumn("begun", F.concat("begun", F.array(tail)))

    def cut(parts: Column, at: Column, to: Column) -> Column:
        first = F.floor(at / PIECE).cast("int")
        some = F.slice(parts, first + 1, F.greatest(F.lit(1), F.ceil(to / PIECE).cast("int") - first))
        return F.substring(F.array_join(some, ""), at % PIECE + 1, to - at)

    out = bound(pieces, lambda parts: F.array_join(F.transform("begun", lambda r: cut(parts, r["at"], r["to"])), mask))
    return rows.withColumn("masked", F.when(F.size("spans") > 0, out).otherwise(F.col("text")))


def redacted(documents: DataFrame, mask: str = "[SECRET]", scope: int = SCOPE) -> DataFrame:
    """The documents, whole, with each reported stretch of the text replaced by ``mask`` (touching or
    overlapping spans by one) and n_chars as it is then, if there is such a column.

    Texts without secrets, null and empty texts stay as they are, n_chars too of a null text; null ids stay;
    repeated rows give repeated rows; columns may have any names; no rows give no rows. There is no shuffle.
    Write the result before filtering by its text: a filter would be planned with all of the scan inside it."""
    found = masked(with_spans(documents.select(whole(documents).alias("row"), "text"), scope), mask)
    row, text = F.col("row"), F.col("masked")
    changed = {"text": text}
    if "n_chars" in documents.columns:
        changed["n_chars"] = F.when(text.isNull(), row["n_chars"]).otherwise(F.length(text).cast(documents.schema["n_chars"].dataType))
    return found.select(*[changed.get(c, row.getField(c)).alias(c) for c in documents.columns])
