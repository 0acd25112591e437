"""One query per operator, over the whole of its table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.common import read
from tallyframe.llm.filter_audit import filter_audit
from tallyframe.llm.fingerprints import fingerprints
from tallyframe.llm.lang_crf import languages
from tallyframe.llm.merkle import document_manifest
from tallyframe.llm.mixing import mixed
from tallyframe.llm.near_dedup import near_duplicates
from tallyframe.llm.piece_transducer import encode_pieces
from tallyframe.llm.quality import quality_scores
from tallyframe.llm.secret_scan import secrets
from tallyframe.llm.sharding import sharded
from tallyframe.llm.token_counts import token_counts
from tallyframe.llm.url_filter import judged, rules_frame
from tallyframe.llm.vector_search import top_products

#: Rules of the URL query: host, path, verdict.
URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file stands; the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(read(spark, sf_dir, "pages"), rules_frame(spark, URL_RULES))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_pieces(read(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"), check=True)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(read(spark, sf_dir, "documents"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded(read(spark, sf_dir, "documents"))


def op7_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products(read(spark, sf_dir, "embeddings"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans")


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(read(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(read(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_manifest(read(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_url_filter,
        op2_token_counts,
        op3_sentencepiece,
        op4_mixing,
        op5_near_duplicates,
        op6_sharding,
        op7_vector_search,
        op8_secret_scan,
        op9_fingerprints,
        op10_quality,
        op11_language_id,
        op12_merkle_manifest,
        op13_filter_audit,
    ]
    return {f.__name__: f for f in found}


_OP1 = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts
), rules(rule_host, rule_path, rule_verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), fits AS (
  SELECT page_id, host, path, rule_host || rule_path AS rule, rule_verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC NULLS LAST, length(rule_host) DESC) AS n
  FROM split LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict FROM fits WHERE n = 1
"""

_OP7 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, d.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, d.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

# The remainders by which the polynomial of CRC-32 (fixed value: 0xEDB88320) divides a byte, and a text's
# checksum from them.
_CRC_TABLE = """
crc_steps AS (
  WITH RECURSIVE s(b, k, c) AS (
    SELECT CAST(range AS BIGINT), 0, CAST(range AS BIGINT) FROM range(256)
    UNION ALL
    SELECT b, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM s WHERE k < 8
  )
  SELECT list(c ORDER BY b) AS t FROM s WHERE k = 8
)"""


def _crc(text: str) -> str:
    """DuckDB SQL for the CRC-32 of a text's UTF-8 bytes; ``t`` is the table."""
    data = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: CAST(('0x' || h) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {data}), lambda c, b: xor(c >> 8, t[CAST((xor(c, b) & 255) + 1 AS BIGINT)])), 4294967295)"


_OP6 = f"""
WITH {_CRC_TABLE}, sized AS (
  SELECT doc_id, source, octet_length(encode(coalesce(text, ''))) + 1 AS size, {_crc("coalesce(text, '')")} AS text_crc32
  FROM documents, crc_steps
), hashed AS (
  SELECT *, md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || CAST(text_crc32 AS VARCHAR)) AS h FROM sized
), ranked AS (
  SELECT *, CAST(2 * row_number() OVER (PARTITION BY source ORDER BY h, doc_id NULLS FIRST, text_crc32, size) - 1 AS DOUBLE) / (2 * count(*) OVER (PARTITION BY source)) AS spread FROM hashed
), placed AS (
  SELECT *, row_number() OVER (ORDER BY spread, h, doc_id NULLS FIRST, text_crc32, size, source NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM ranked
), cut AS (
  SELECT *, n // 16 AS short, n % 16 AS longer FROM placed
), sharded AS (
  SELECT *, CASE WHEN place < longer * (short + 1) THEN place // (short + 1) ELSE longer + (place - longer * (short + 1)) // greatest(1, short) END AS shard FROM cut
)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'rows' AS law, CAST(shard AS INTEGER) AS shard,
       CAST(place - shard * short - least(shard, longer) AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard, source
FROM sharded
"""

_OP12 = f"""
WITH RECURSIVE {_CRC_TABLE}, shown AS (
  SELECT doc_id, lang, text, {_crc("coalesce(CAST(doc_id AS VARCHAR), '')")} % 3 = 0 AS tampered,
         coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-') ||
         coalesce(octet_length(encode(lang)) || ':' || lang, '-') || coalesce(length(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered
  FROM documents, crc_steps
), leaves AS (
  SELECT doc_id, lang, coalesce('=' || lang, '') AS key, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
         CASE WHEN tampered THEN sha256(head || coalesce(octet_length(encode(lowered)) || ':' || lowered, '-')) END AS changed
  FROM shown
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf, changed NULLS FIRST) - 1 AS pos, count(*) OVER (PARTITION BY key) AS m FROM leaves
), nodes(key, level, pos, h, m) AS (
  SELECT key, 0, pos, leaf, m FROM placed
  UNION ALL
  SELECT key, level + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (max(m) + 7) // 8 FROM nodes WHERE m > 1 GROUP BY key, level, pos // 8
), subroots AS (
  SELECT key, h AS subroot, row_number() OVER (ORDER BY encode(key)) - 1 AS pos, count(*) OVER () AS m FROM nodes WHERE m = 1
), upper(level, pos, h, m) AS (
  SELECT 0, pos, subroot, m FROM subroots
  UNION ALL
  SELECT level + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (max(m) + 7) // 8 FROM upper WHERE m > 1 GROUP BY level, pos // 8
), folded(key, leaf_pos, level, pos, h, others, m) AS (
  SELECT key, pos, 0, pos, coalesce(changed, leaf), '', m FROM placed
  UNION ALL
  SELECT f.key, f.leaf_pos, f.level + 1, f.pos // 8, sha256(string_agg(CASE WHEN n.pos = f.pos THEN f.h ELSE n.h END, '' ORDER BY n.pos)),
         f.others || coalesce(string_agg(n.h, '' ORDER BY n.pos) FILTER (n.pos <> f.pos), ''), (f.m + 7) // 8
  FROM folded f JOIN nodes n ON n.key = f.key AND n.level = f.level AND n.pos // 8 = f.pos // 8 WHERE f.m > 1
  GROUP BY f.key, f.leaf_pos, f.level, f.pos, f.h, f.others, f.m
), whole(key, leaf_pos, level, pos, h, others, m) AS (
  SELECT f.key, leaf_pos, 0, s.pos, h, others, s.m FROM folded f JOIN subroots s USING (key) WHERE f.m = 1
  UNION ALL
  SELECT f.key, f.leaf_pos, f.level + 1, f.pos // 8, sha256(string_agg(CASE WHEN n.pos = f.pos THEN f.h ELSE n.h END, '' ORDER BY n.pos)),
         f.others || coalesce(string_agg(n.h, '' ORDER BY n.pos) FILTER (n.pos <> f.pos), ''), (f.m + 7) // 8
  FROM whole f JOIN upper n ON n.level = f.level AND n.pos // 8 = f.pos // 8 WHERE f.m > 1
  GROUP BY f.key, f.leaf_pos, f.level, f.pos, f.h, f.others, f.m
)
SELECT p.doc_id, p.leaf, s.subroot, r.h AS root, sha256(o.others) AS proof_sha256, o.h AS folded_root, o.h = r.h AS verified, p.lang
FROM placed p JOIN whole o ON o.key = p.key AND o.leaf_pos = p.pos AND o.m = 1 JOIN subroots s ON s.key = p.key JOIN upper r ON r.m = 1
"""

_OP13 = r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), marks AS (
  SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), failing AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         CASE WHEN len(words) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * list_unique(words) < 50 * len(words) THEN 'B' ELSE '' END ||
         CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 'C' ELSE '' END || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END ||
         CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
  FROM texts LEFT JOIN marks USING (doc_id)
), letters(f) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')), orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), steps AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS own, filter_order[1:step - 1] AS earlier FROM orders, range(1, 6) AS r(step)
), met AS (
  SELECT *, contains(fails, own) AS hit, translate(fails, earlier, '') <> fails AS gone FROM failing, steps
), counted AS (
  SELECT part, filter_order, step, own, count(*) FILTER (NOT hit AND NOT gone) AS kept, count(*) FILTER (hit AND NOT gone) AS removed,
         count(*) FILTER (hit AND gone) AS redundant, count(*) FILTER (fails = own) AS unique_fails,
         count(*) FILTER (good AND hit AND NOT gone) AS good_lost, count(*) FILTER (toxic AND hit AND NOT gone) AS toxic_lost
  FROM met GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM counted
"""


def oracle_sql() -> dict[str, str]:
    """SQL for the queries whose rows it can express. The others are tested against brute force, the
    libraries they must equal, or held-out labels."""
    return {"op1_url_filter": _OP1, "op6_sharding": _OP6, "op7_vector_search": _OP7, "op12_merkle_manifest": _OP12, "op13_filter_audit": _OP13}
