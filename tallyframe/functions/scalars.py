"""Scalar functions (FN01-FN29): columns in, columns out, all built from Spark's own expressions but for
the exact 64-bit BLAKE2b, which is an Arrow UDF."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tallyframe.schemas import AGE_BRACKETS

ColumnLike = Column | str


def _c(x: ColumnLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


def zfill(x: ColumnLike, n: int) -> Column:
    """FN02: zeros in front up to n characters; longer texts stay, unlike with lpad."""
    x = _c(x)
    return F.when(F.length(x) < n, F.lpad(x, n, "0")).otherwise(x)


def normalize_vuid(x: ColumnLike) -> Column:
    """FN01: the last ten digits, with zeros in front; without digits the text itself, so padded."""
    raw = F.trim(_c(x))
    digits = F.regexp_replace(raw, "[^0-9]", "")
    kept = F.when(digits == "", raw).otherwise(digits)
    return F.when(kept == "", "").otherwise(F.right(zfill(kept, 10), F.lit(10)))


def county_key(x: ColumnLike) -> Column:
    """FN03: the letters A-Z of the upper-cased name."""
    return F.regexp_replace(F.upper(_c(x)), "[^A-Z]", "")


def normalize_precinct(x: ColumnLike) -> Column:
    """FN04: four digits of what digits there are, else the trimmed upper-case text."""
    raw = F.upper(F.trim(_c(x)))
    digits = F.regexp_replace(raw, "[^0-9]", "")
    core = F.regexp_replace(digits, "^0+", "")
    return F.when(digits == "", raw).otherwise(F.lpad(F.right(F.when(core == "", "0").otherwise(core), F.lit(4)), 4, "0"))


def normalize_method(x: ColumnLike) -> Column:
    """FN05: in_person, mail_in or null, from a lenient set of spellings."""
    text = F.upper(F.trim(_c(x)))
    return F.when(text.isin("IN-PERSON", "IN PERSON", "INPERSON"), "in_person").when(text.isin("MAIL-IN", "MAIL IN", "MAILIN", "MAIL"), "mail_in")


def parse_method(x: ColumnLike) -> Column:
    """FN06: MAIL-IN where the text has MAIL in it, else IN-PERSON."""
    return F.when(F.contains(F.upper(_c(x)), F.lit("MAIL")), "MAIL-IN").otherwise("IN-PERSON")


def age_at(dob: ColumnLike, day: ColumnLike) -> Column:
    """FN08: whole years; a birthday on 29 February has passed on 1 March."""
    dob, day = _c(dob), _c(day)
    early = (F.date_format(day, "MMdd") < F.date_format(dob, "MMdd")).cast("int")
    return F.year(day) - F.year(dob) - early


def parse_dob(x: ColumnLike) -> Column:
    """The three date formats of registers."""
    raw = F.trim(_c(x))
    plain = F.when(F.rlike(raw, F.lit("^[0-9]{8}$")), F.try_to_date(raw, "yyyyMMdd"))
    iso = F.when(F.rlike(raw, F.lit(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$")), F.try_to_date(raw, "yyyy-M-d"))
    american = F.when(F.rlike(raw, F.lit(r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$")), F.try_to_date(raw, "M/d/yyyy"))
    return F.coalesce(plain, iso, american)


def age_bracket(dob: ColumnLike, day: ColumnLike) -> Column:
    """FN07: one of seven brackets, or null."""
    age = age_at(parse_dob(dob), day)
    out = F.lit(None).cast("string")
    for low, high, label in reversed(AGE_BRACKETS):
        out = F.when(age.between(low, high), label).otherwise(out)
    return out


def ymd(x: ColumnLike, min_year: int, today: ColumnLike) -> Column:
    """FN09: eight digits as a date from ``min_year`` to ``today``, else null."""
    raw = _c(x)
    day = F.when(F.rlike(raw, F.lit("^[0-9]{8}$")), F.try_to_date(raw, "yyyyMMdd"))
    return F.when((F.year(day) >= min_year) & (day <= _c(today)), day)


def vote_mode(code: ColumnLike) -> Column:
    """FN10: early, absentee or election_day, from a history code's suffix; null without a code."""
    code = _c(code)
    last = F.right(code, F.lit(1))
    mode = F.when((F.length(code) > 1) & (last == "E"), "early").when((F.length(code) > 1) & (last == "A"), "absentee").otherwise("election_day")
    return F.when(code.isNotNull() & (code != ""), mode)


def earliness(day: ColumnLike, days: ColumnLike) -> Column:
    """FN12: 1 on the first early day, 0 on the last."""
    return (_c(days) - _c(day)) / (_c(days) - 1)


def pattern(first: Column, second: Column, labels: Sequence[str]) -> Column:
    """FN13: labels for both, the first only, the second only, neither."""
    return F.when((first > 0) & (second > 0), labels[0]).when(first > 0, labels[1]).when(second > 0, labels[2]).otherwise(labels[3])


def typical_mode(early: Column, absentee: Column, election_day: Column) -> Column:
    """FN14: the mode used most, mixed on a tie, null without votes."""
    most = F.greatest(early, absentee, election_day)
    ties = sum(((x == most).cast("int") for x in (early, absentee, election_day)), F.lit(0))
    return F.when(most > 0, F.when(ties > 1, "mixed").when(early == most, "early").when(absentee == most, "absentee").otherwise("election_day"))


def row_hash(columns: Sequence[ColumnLike]) -> Column:
    """FN15: 64 bits of the columns' values; a null differs from an empty text."""
    return F.xxhash64(F.to_json(F.array(*[_c(c).cast("string") for c in columns])))


def exact_row_hash(spark: SparkSession, columns: Sequence[ColumnLike]) -> Column:
    """FN15 by BLAKE2b over length-prefixed values, for stores that hold such hashes: an Arrow UDF."""
    from tallyframe.workers import ship_package

    ship_package(spark)

    @F.pandas_udf("long")
    def blake(values):
        import hashlib

        import pandas as pd

        def one(row) -> int:
            state = hashlib.blake2b(digest_size=8)
            for value in row:
                if value is None:
                    state.update(b"\xff" * 4)
                else:
                    data = value.encode()
                    state.update(len(data).to_bytes(4, "big") + data)
            return int.from_bytes(state.digest(), "big", signed=True)

        return pd.Series([one(row) for row in values], dtype="int64")

    return blake(F.array(*[_c(c).cast("string") for c in columns]))


def day_number(day: ColumnLike) -> Column:
    """FN16: days from 1 January of year 1, which is day 1."""
    return F.datediff(_c(day), F.lit("0001-01-01").cast("date")) + 1


def day_of_number(number: ColumnLike) -> Column:
    """FN16, backwards."""
    return F.date_add(F.lit("0001-01-01").cast("date"), (_c(number) - 1).cast("int"))


def district_key(x: ColumnLike) -> Column:
    """FN17: trimmed, without zeros in front, upper-cased."""
    return F.upper(F.regexp_replace(F.trim(_c(x)), "^0+", ""))


def pack_bits(*flags: Column) -> Column:
    """FN18: the first flag is bit 0; null counts as unset."""
    out = F.lit(0)
    for i, flag in enumerate(flags):
        out = out.bitwiseOR(F.when(F.coalesce(flag, F.lit(False)), 1 << i).otherwise(0))
    return out


# What an election's name holds, in order, and its type.
ELECTION_TYPES = (("primary runoff", "primary_runoff"), ("primary", "primary"), ("general", "general"), ("special runoff", "special"), ("special", "special"), ("constitutional", "constitutional_amendment"), ("local", "local"))


def election_type(name: ColumnLike) -> Column:
    """FN19: the first type whose words the name has."""
    out, name = F.lit("unknown"), F.lower(_c(name))
    for words, kind in reversed(ELECTION_TYPES):
        out = F.when(F.contains(name, F.lit(words)), kind).otherwise(out)
    return out


# Names that register columns go by, without spaces, underlines and hyphens.
REGISTER_FIELDS = {
    "vuid": ("vuid", "idvoter", "voterid", "vanid", "lalvoterid", "registrantid", "statecodevoterid"),
    "cd": ("cd", "congdist", "congressional", "ushouse", "conghouse"),
    "hd": ("hd", "housedist", "statehouse", "lowerchamber"),
    "sd": ("sd", "senatedist", "statesenate", "upperchamber"),
    "county": ("county", "countyname", "co"),
    "precinct": ("pct", "precinct", "precinctcode", "pctcode", "precinctnum"),
    "last_name": ("lname", "lastname", "last", "surname"),
    "first_name": ("fname", "firstname", "first"),
    "full_name": ("fullname", "votername", "name"),
    "dob": ("dob", "dateofbirth", "birthdate", "birthdt", "birth"),
    "sex": ("sex", "gender"),
    "hispanic": ("hispanic", "hisp", "ethnicity"),
    "status": ("status", "voterstatus", "regstatus"),
}


def detect_columns(header: Sequence[str]) -> dict[str, tuple[str, str]]:
    """FN20: field -> (column, exact, pattern or prefix) guessed from a header; fields not found are left out.

    Works on column names only. Prefixes count for district columns, before a digit, plan or dist."""
    plain = {re.sub(r"[\s_-]", "", c.lower()): c for c in header}
    out: dict[str, tuple[str, str]] = {}
    for field, names in REGISTER_FIELDS.items():
        district = re.compile(rf"{field}(\d|plan|dist)") if field in ("cd", "hd", "sd") else None
        tries = (
            ("exact", (c for n, c in plain.items() if n == field.replace("_", ""))),
            ("pattern", (c for n, c in plain.items() if n in names)),
            ("prefix", (c for n, c in plain.items() if district and district.match(n))),
        )
        for kind, found in tries:
            if (column := next(found, None)) is not None:
                out[field] = (column, kind)
                break
    return out


def column_conflicts(mapping: dict[str, tuple[str, str]]) -> dict[str, list[str]]:
    """FN20: columns that several fields are mapped to, with the fields."""
    by_column: dict[str, list[str]] = {}
    for field, (column, _) in mapping.items():
        by_column.setdefault(column, []).append(field)
    return {c: fields for c, fields in sorted(by_column.items()) if len(fields) > 1}


def updated_time(x: ColumnLike) -> Column:
    """FN21: a timestamp from one of three formats or ISO; null otherwise. Session time zone: UTC."""
    raw = F.trim(_c(x))
    formats = ("M/d/yyyy h:mm:ss a", "M/d/yyyy h:mm a", "yyyy-MM-dd HH:mm:ss")
    return F.coalesce(*[F.try_to_timestamp(raw, F.lit(f)) for f in formats], raw.try_cast("timestamp"))


def clean_cell(x: ColumnLike, null_word: bool = False) -> Column:
    """FN22: trimmed, with null for blanks and, if asked for, for the word NULL."""
    text = F.trim(_c(x))
    return F.when((text != "") & (~(F.upper(text) == "NULL") if null_word else F.lit(True)), text)


def coordinate(x: ColumnLike) -> Column:
    """FN23: six decimals, half to even."""
    return F.bround(_c(x), 6)


def key_ranges(n: int) -> list[tuple[int, int]]:
    """FN24: n ranges that tile the signed 64-bit numbers; the last takes the rest."""
    step = (1 << 64) // n
    low = [-(1 << 63) + i * step for i in range(n)]
    return [(a, b - 1) for a, b in zip(low, [*low[1:], 1 << 63], strict=True)]


def range_of(h: ColumnLike, n: int) -> Column:
    """FN24: which of the n ranges a hash is in."""
    whole = lambda k: F.lit(str(k)).cast("decimal(20,0)")
    shifted = _c(h).cast("decimal(20,0)") + whole(1 << 63)
    return F.least(F.lit(n - 1), F.floor(shifted / whole((1 << 64) // n)).cast("int"))


def appearance_token(county: ColumnLike, day: ColumnLike) -> Column:
    """FN25: COUNTY|YYYY-MM-DD."""
    return F.concat_ws("|", _c(county), F.date_format(_c(day), "yyyy-MM-dd"))


def safe_filename_component(x: ColumnLike) -> Column:
    """FN26: what isn't a letter, digit, point, underline or hyphen becomes an underline."""
    return F.regexp_replace(_c(x), r"[^A-Za-z0-9._-]+", "_")


def has_duplicate_flag(types: ColumnLike, flag: str) -> Column:
    """FN27: whether a comma-separated list has the token."""
    return F.array_contains(F.transform(F.split(_c(types), ","), lambda x: F.trim(x)), flag)


def json_payload_hash(text: ColumnLike) -> Column:
    """FN28: sha256 of a flat JSON object's entries in order of their keys."""
    entries = F.map_entries(F.from_json(_c(text), "map<string,string>"))
    return F.sha2(F.to_json(F.sort_array(entries)), 256)


def canonical_line(columns: Sequence[ColumnLike]) -> Column:
    """FN29: a row as one CSV line."""
    return F.to_csv(F.struct(*[_c(c).cast("string") for c in columns]))


def day_digest(lines: Column) -> Column:
    """FN29: sha256 of a day's lines, whatever their order; an aggregate.

    It hashes the number of lines and four sums, each of 60 bits of the lines' own hashes, so no lines are
    gathered and tasks combine before the shuffle. It tells files apart; it doesn't withstand forgery."""
    hashed = F.sha2(lines, 256)
    sums = [F.sum(F.conv(F.substring(hashed, 1 + 15 * k, 15), 16, 10).cast("decimal(20,0)")).cast("string") for k in range(4)]
    return F.sha2(F.concat_ws(":", F.count(lines).cast("string"), *sums), 256)


def valid_election_id(x: ColumnLike) -> Column:
    """PRJ07: digits, not all zero; zeros in front stay."""
    return F.rlike(_c(x), F.lit("^[0-9]+$")) & ~F.rlike(_c(x), F.lit("^0+$"))


def payload_kind(text: ColumnLike) -> Column:
    """PRJ08: turnout for what begins like JSON, else roster."""
    return F.when(F.substring(F.ltrim(_c(text)), 1, 1).isin("{", "["), "turnout").otherwise("roster")
