"""The ten operators against brute force, the libraries they equal, and edge cases."""

import hashlib
import itertools
import random
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import fingerprints as FP
from tallyframe.llm import mixing as M
from tallyframe.llm import near_dedup as ND
from tallyframe.llm import piece_transducer as PT
from tallyframe.llm import quality as QL
from tallyframe.llm import queries
from tallyframe.llm import secret_scan as SS
from tallyframe.llm import sharding as SH
from tallyframe.llm import token_counts as TC
from tallyframe.llm import url_filter as UF
from tallyframe.llm import vector_search as VS
from tallyframe.llm import common as C

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Nulls, empty and blank texts, repeats of rows and ids, odd characters, a very long text.
ODD = [(None, None, None), (1, None, "x"), (2, "", None), (3, " \n\t", "y"), (4, "a b", "x"), (4, "a b", "x"), (4, "other text here", "x"), (5, "é😀 \x00 日本 <|endoftext|> token=abcdef1", "z"), (None, "no id", "x"), (6, "word and " * 30_000, "y"), (7, "ab1é" * 20_000, "y"), (8, "x" * 20_000, "z"), (9, "日本語" * 8_000 + "\n" * 10_000, "z")]


@pytest.fixture(scope="module")
def odd(spark):
    """With extra columns whose names operators use inside."""
    rows = spark.createDataFrame(ODD, "doc_id long, text string, source string")
    return rows.withColumns({c: F.lit(7) for c in ("size", "n_chars", "key", "part", "bucket", "u", "v", "h", "rank", "place", "score", "label", "kind", "id", "lang", "row", "whole", "maybe", "hash", "n", "copies", "masked", "spans", "base", "weak", "every", "pieces", "begun", "ends", "linked", "covered", "kept", "ids", "taken", "more", "low", "salt", "slot", "at", "first", "__text", "__spans", "__maybe", "__taken", "__key", "__at", "__copy", "a.b `c")}).repartition(3)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(name, same_rows):
    same_rows(queries.queries()[name], queries.oracle_sql()[name])


# 1


def brute_verdict(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = re.split("[?#]", rest[cut:])[0]
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return (host, path, best[3], best[4]) if best else (host, path, None, "allow")


def test_url_rules_equal_brute_force(spark):
    rnd = random.Random(2)
    rules = [(".".join(rnd.choice("abc") for _ in range(rnd.randint(1, 4))), rnd.choice(["", "/", "/a", "/a/b", "/ab"]), rnd.choice(["allow", "block"])) for _ in range(40)]
    urls = [None, "", "x", "http://", "HTTP://A.b?x", "ftp://a.b/#q", "a://b://c"] + ["http://" + ".".join(rnd.choice(["a", "b", "c", "B", "ab"]) for _ in range(rnd.randint(1, 6))) + rnd.choice(["", "/", "/a", "/a/b?c", "/ab#/a", "?a"]) for _ in range(1000)] + ["http://hot.a.b/a/b"] * 500
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("key", F.lit(1)).repartition(4)
    got = {r.page_id: tuple(r)[1:] for r in UF.judged(pages, UF.rules_frame(spark, rules)).collect()}
    assert got == {i: brute_verdict(u, rules) for i, u in enumerate(urls)}
    assert UF.judged(pages.limit(0), UF.rules_frame(spark, rules)).count() == 0


# 2


def test_prefix_counts_equal_the_library():
    from tokenizers import Tokenizer

    library, counter = Tokenizer.from_file(BPE), TC.PrefixCounter(BPE)
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    rnd = random.Random(1)
    parts = ["a", "b", "the", " ", "  ", "\n", "'s", "'", "'re", "1", "22", "!", "é", "日本", "<|endoftext|>", "<|", "|>", "😀", "ll", "\u00a0", "\u2003"]
    for _ in range(400):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12)))
        want = [count(text[:i]) for i in range(len(text) + 1)]
        assert list(counter.prefixes(text)) == want
        budget = rnd.randint(1, 6)
        assert counter.measure(text, budget) == (want[-1], max(i for i, n in enumerate(want) if n <= budget))


def test_token_counts_equal_the_library(spark, docs, odd):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BPE)
    for frame in (docs, odd):
        got = sorted(((r.doc_id or -1), r.n_bytes, r.n_tokens, r.over_limit) for r in TC.token_counts(frame, BPE).collect())
        want = sorted(((r.doc_id or -1), len((r.text or "").encode()), n := len(library.encode(r.text or "", add_special_tokens=False).ids), n > 1024) for r in frame.collect())
        assert got == want
    assert TC.token_counts(docs.limit(0), BPE).count() == 0
    # every prefix's count, on Spark
    texts = ["", None, "a few words, 12 of them", "é😀 <|endoftext|> x", "ab1é" * 20]
    few = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    for r in TC.token_counts(few, BPE, limit=5, prefixes=True).collect():
        text = texts[r.doc_id] or ""
        want = [len(library.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
        assert r.prefix_tokens == want and r.fit_chars == max(i for i, n in enumerate(want) if n <= 5)


# 3


def test_pieces_equal_the_library(docs, odd):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for frame in (docs, odd):
        encoded = PT.encode_pieces(frame, PIECES, keep=("doc_id", "text"), check=True)
        for r in encoded.collect():
            assert r.ids == library.encode(r.text or "") and r.n_ids == len(r.ids) and r.round_trip
    assert PT.encode_pieces(docs.limit(0), PIECES).count() == 0


def test_pieces_of_long_texts_without_spaces():
    import sentencepiece

    library, machine = sentencepiece.SentencePieceProcessor(model_file=PIECES), PT.PieceTransducer(PIECES)
    for text in ("word\n" * 100_000, "\n" * 100_000, "\t" * 10_000, "".join(chr(i % 32) for i in range(20_000)), "x" * 20_000, " " * 5_000, "日本語" * 3_000, "a first\tone" + "\n日本,\t12.\n\n" * 15_000 + " end"):
        ids = np.frombuffer(machine.encode(text), np.int32)
        assert ids.tolist() == library.encode(text) and machine.decode(ids) == text


def field(number, value):
    """A field of a protocol buffer message."""

    def varint(x):
        out = b""
        while x > 127:
            out, x = out + bytes([x & 127 | 128]), x >> 7
        return out + bytes([x])

    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    return varint(number << 3 | 2) + varint(len(value)) + value


def test_pieces_of_a_unigram_model(tmp_path):
    import sentencepiece

    rnd = random.Random(9)
    names = {"▁", "▁the", "▁a", "the", "he", "日本"} | {"".join(rnd.choice("abchet▁") for _ in range(rnd.randint(1, 5))) for _ in range(150)} | set("abche")
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)] + [(n, -rnd.uniform(2, 12), 1) for n in sorted(names)]
    model = b"".join(field(1, field(1, n.encode()) + field(2, float(s)) + field(3, k)) for n, s, k in pieces)
    model += field(2, field(3, 1) + field(4, len(pieces)) + field(35, 1)) + field(3, field(1, b"identity") + field(3, 1) + field(4, 0) + field(5, 1))
    path = str(tmp_path / "unigram.model")
    with open(path, "wb") as f:
        f.write(model)
    library, machine = sentencepiece.SentencePieceProcessor(model_file=path), PT.PieceTransducer(path)
    texts = ["", " ", "the a", "日本語 é the", *("".join(rnd.choice("abchet  日本語\n") for _ in range(rnd.randint(1, 200))) for _ in range(200)), "the cab bat\n" * 2000]
    for text in texts:
        ids = np.frombuffer(machine.encode(text), np.int32)
        assert ids.tolist() == library.encode(text) and machine.decode(ids) == text


def test_pieces_of_odd_ids(spark):
    frame = spark.createDataFrame([(1, [], "k"), (1, [], "k"), (2, [None, 260, None], None), (None, [260], "z")], "doc_id long, ids array<int>, text string")
    assert sorted(str(tuple(r)) for r in PT.decode_pieces(frame, PIECES).collect()) == sorted(str(x) for x in [(1, ""), (1, ""), (2, PT.transducer(PIECES).decode(np.array([260]))), (None, PT.transducer(PIECES).decode(np.array([260])))])
    for bad in (-1, 32_000):
        with pytest.raises(Exception, match="outside the model"):
            PT.decode_pieces(spark.createDataFrame([(1, [bad])], "doc_id long, ids array<int>"), PIECES).collect()


def test_pieces_decode_as_the_library(spark):
    import sentencepiece

    library, rnd = sentencepiece.SentencePieceProcessor(model_file=PIECES), random.Random(3)
    ids = [[rnd.randrange(32_000) if rnd.random() < 0.7 else rnd.randrange(3, 259) for _ in range(rnd.randint(0, 8))] for _ in range(300)]
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(ids)] + [(999, None)], "doc_id long, ids array<int>")
    got = {r.doc_id: r.text for r in PT.decode_pieces(frame, PIECES).collect()}
    assert got == {i: library.decode(x) for i, x in enumerate(ids)} | {999: ""}


# 4


def brute_targets(sizes):
    weights = dict(zip(sorted(sizes, key=lambda s: (s is None, s)), itertools.cycle((5, 2, 1)), strict=False))
    left, total, out = set(sizes), 1.5 * sum(sizes.values()), {}
    while left:
        share = total / sum(weights[s] for s in left)
        over = {s for s in left if share * weights[s] > 2 * sizes[s]}
        if not over:
            return out | {s: share * weights[s] for s in left}
        for s in over:
            out[s] = 2.0 * sizes[s]
            total -= out[s]
        left -= over
    return out


def test_mixing_meets_its_targets(spark, docs, odd):
    for frame in (docs, odd):
        rows = M.mixed(frame).collect()
        texts = frame.collect()
        assert sorted((r.doc_id or -1, r["size"]) for r in rows) == sorted((r.doc_id or -1, len(WORD.findall(r.text or ""))) for r in texts)
        sizes: dict = {}
        for r in texts:
            sizes[r.source] = sizes.get(r.source, 0) + len(WORD.findall(r.text or ""))
        targets = brute_targets(sizes)
        for source, size in sizes.items():
            own = [r for r in rows if r.source == source]
            assert {r.source_size for r in own} == {size}
            assert all(abs(r.target - targets[source]) < 1e-6 * max(1, size) for r in own)
            assert abs(sum(r.taken for r in own) - targets[source]) <= max(r["size"] for r in own) + 1e-6
            assert all(r.taken in {k * r["size"] for k in range(3)} for r in own)
        again = M.mixed(frame.repartition(5)).collect()
        assert sorted(map(str, again)) == sorted(map(str, rows))
        taken = M.mix(frame)
        assert taken.columns == frame.columns
        assert taken.count() == sum(r.copies for r in rows)
    assert M.mixed(docs.limit(0)).count() == 0


def test_mixing_settles_over_many_blocks(spark):
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 5).cast("string"))).alias("source"), F.repeat(F.lit("w "), (F.col("id") % 17).cast("int")).alias("text"))
    sums = M.mixed(rows).groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect()
    assert all(abs(r.taken - r.target) <= 17 for r in sums)


def test_mixing_of_equal_rows_and_many_sources(spark, monkeypatch):
    """Two million rows alike; and targets that are dealt out, not broadcast, with the same result."""
    alike = spark.range(2_000_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("s").alias("source"), F.lit("a b c").alias("text"))
    row = M.mixed(alike).agg(F.count("*").alias("n"), F.sum("taken").alias("taken"), F.max("target").alias("target")).first()
    assert row.n == 2_000_000 and abs(row.taken - row.target) <= 3
    few = spark.createDataFrame([(k % 70, f"s{k % 30}" if k % 9 else None, "w " * (k % 11)) for k in range(900)], "doc_id long, source string, text string")
    want = sorted(map(str, M.mixed(few).collect()))
    assert "BroadcastHashJoin" in M.mixed(few)._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(M, "FEW", 3)
    assert sorted(map(str, M.mixed(few).collect())) == want


def test_mixing_keeps_each_documents_mean(spark):
    """Over many seeds a document is taken target / source_size times on average, whatever its size."""
    rows = spark.createDataFrame([(k, "ab"[k % 2], "w " * (1 + k % 7)) for k in range(60)], "doc_id long, source string, text string")
    total: dict = {}
    for seed in range(12):
        for r in M.mixed(rows, seed=seed).collect():
            total.setdefault(r.doc_id, []).append((r.copies, r.target / r.source_size))
    off = [abs(np.mean([c for c, _ in x]) - x[0][1]) for x in total.values()]
    assert np.mean(off) < 0.15 and max(off) < 0.6


def test_mix_of_a_hot_id(spark, monkeypatch):
    """Null and repeated ids: each group's decisions are met, no row is lost, and order doesn't matter."""
    monkeypatch.setattr(M, "SALTED", 100)
    made = [(None, f"t{i} b", "x", i % 2) for i in range(1500)] + [(7, f"u{i}" + " v" * (i % 3), None, 0) for i in range(600)] + [(None, "same text", "x", 0)] * 400 + [(i, f"own {i}", "yz"[i % 2], 1) for i in range(900)] + [(None, None, "x", None), (None, "x", None, None)]
    frame = spark.createDataFrame(made, "doc_id long, text string, source string, extra int")
    want = {}
    for r in M.mixed(frame).collect():
        want[r.doc_id, r.source, r["size"]] = want.get((r.doc_id, r.source, r["size"]), 0) + r.copies
    mixed = M.mix(frame)
    assert mixed.columns == frame.columns
    assert "collect_list" not in mixed._jdf.queryExecution().toString()
    rows, got, each = mixed.collect(), {}, {}
    for r in rows:
        key = (r.doc_id, r.source, len(WORD.findall(r.text or "")))
        got[key] = got.get(key, 0) + 1
        each[tuple(r)] = each.get(tuple(r), 0) + 1
    assert got == {k: n for k, n in want.items() if n}
    assert all(n <= 2 * made.count(k) for k, n in each.items())
    again = M.mix(frame.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


# 5


def shingles(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute_groups(rows, similarity=85):
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def near_copies(seed):
    rnd, rows = random.Random(seed), []
    for _ in range(25):
        base = [f"w{rnd.randrange(5000)}" for _ in range(rnd.choice([3, 5, 8, 12, 20, 60, 150]))]
        for _ in range(rnd.choice([1, 2, 5, 15])):
            text = list(base)
            for _ in range(rnd.randint(0, max(1, len(text) // 40))):
                text[rnd.randrange(len(text))] = f"x{rnd.randrange(9999)}"
            rows.append((len(rows), " ".join(text)))
    return [*rows, (9000, ""), (9001, None), (9002, " \n"), (9003, "A b"), (9004, "a B")]


def test_near_duplicates_equal_brute_force(spark, docs):
    for rows in (near_copies(3), [(r.doc_id, r.text) for r in docs.collect()]):
        got = ND.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
        assert {r.doc_id: tuple(r)[1:] for r in got} == brute_groups(rows)


def test_near_duplicates_at_the_threshold(spark):
    """Many copies of one text whose edits leave pairs on both sides of the threshold."""
    rnd, base, rows = random.Random(5), [f"w{i}" for i in range(200)], []
    for i in range(150):
        text = list(base)
        for _ in range(rnd.choice([2, 3])):
            text[rnd.randrange(200)] = f"x{rnd.randrange(99_999)}"
        rows.append((i, " ".join(text)))
    got = ND.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == brute_groups(rows)


def test_near_duplicates_without_hubs(spark, monkeypatch):
    """Groups that stars leave open: page templates with own parts, and texts of common passages."""
    monkeypatch.setattr(ND, "RARE", 2)
    rnd = random.Random(6)
    for tails in ((100,), (20, 25, 30, 35, 40)):
        rows = [(i, " ".join([f"t{j}" for j in range(300)] + [f"u{i}_{j}" for j in range(rnd.choice(tails))])) for i in range(120)]
        got = ND.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert {r.doc_id: tuple(r)[1:] for r in got} == brute_groups(rows)
    passages = [" ".join(f"p{a}_{j}" for j in range(30)) for a in range(12)]
    rows = [(i, " ".join([passages[a] for a in sorted(rnd.sample(range(12), 10))] + [f"z{i}_{j}" for j in range(rnd.choice([0, 0, 5, 12]))])) for i in range(120)]
    for similarity in (80, 85):
        got = ND.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 5, similarity).collect()
        assert {r.doc_id: tuple(r)[1:] for r in got} == brute_groups(rows, similarity)


def test_sketches_bound_what_sets_have_apart():
    rng = np.random.default_rng(4)
    for _ in range(300):
        every = np.unique(rng.integers(0, 1 << 63, rng.integers(2, 900), np.uint64) * np.uint64(2))
        a, b = (np.sort(every[rng.random(len(every)) < rng.uniform(0.3, 1)]) for _ in range(2))
        if len(a) and len(b):
            apart = ND.bins_apart(*(np.frombuffer(ND.sketch(x), np.uint8) for x in (a, b)))
            assert apart <= len(np.setxor1d(a, b))
            assert ND.bins_apart(*(np.frombuffer(ND.sketch(a), np.uint8),) * 2) == 0


def test_near_duplicates_edits_below_the_threshold(spark, monkeypatch):
    """Edits of one text, no two of them linked but for a few: they aren't compared with each other."""
    rnd = random.Random(11)
    base = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(150):
        words = list(base)
        for j in rnd.sample(range(400), 9):
            words[j] = f"e{i}_{j}"
        rows.append((i, " ".join(words)))
    rows += [(150 + i, rows[i][1] + f" end{i}") for i in range(3)]
    compared, confirmed = [], ND.confirmed

    def counted(pairs, sets, similarity, keep):
        compared.append(pairs.count())
        return confirmed(pairs, sets, similarity, keep)

    monkeypatch.setattr(ND, "confirmed", counted)
    got = ND.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == brute_groups(rows)
    assert sum(compared) < 8 * len(rows)


def test_near_duplicates_of_odd_rows(spark, odd):
    got = sorted(((r.doc_id or -1), r.n_shingles, r.component_id or -1, r.kept) for r in ND.near_duplicates(odd).collect())
    assert len(got) == len(ODD)
    assert [g for g in got if g[0] == -1] == [(-1, 0, -1, True), (-1, 1, -1, True)]
    single = ND.without_near_duplicates(odd)
    assert single.columns == odd.columns and single.count() == len(ODD) - 1  # of two equal rows one stays
    copies = spark.createDataFrame([(1, "a b c"), (2, "a b c"), (2, "another text"), (3, "A b c"), (None, "A B c"), (None, "new one"), (None, "New one"), (None, "new one"), (9, ""), (9, None)], "doc_id long, text string")
    assert sorted(str(r.doc_id) for r in ND.without_near_duplicates(copies).collect()) == ["1", "2", "9", "9", "None"]
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in ND.near_duplicates(copies).collect()}
    assert got == {(1, 1, 1, True), (2, 1, 1, False), (2, 1, 2, True), (3, 1, 1, False), (None, 1, 1, False), (None, 1, None, True), (9, 0, 9, True)}
    assert ND.near_duplicates(odd.limit(0)).count() == 0


def test_bitmap_joins_are_exact(spark):
    rows = spark.range(5000).select(F.col("id").alias("k"), F.lit(None).alias("row"), F.lit(1).alias("maybe"), F.lit("x").alias("a.b `c"))
    ids = rows.where("k % 7 = 0").select(C.row_hash(rows).alias("row"))
    assert C.matched_rows(rows, ids, "left_semi").count() == ids.count() == 715
    rest = C.matched_rows(rows, ids, "left_anti")
    assert rest.columns == rows.columns and {r.k for r in rest.collect()} == {k for k in range(5000) if k % 7}


# 6


def test_shards_are_even_and_mixed(docs, odd):
    for frame in (docs, odd):
        rows = SH.sharded(frame).collect()
        texts = frame.collect()
        assert sorted((r.doc_id or -1, r["size"], r.text_crc32) for r in rows) == sorted((r.doc_id or -1, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in texts)
        counts = [sum(r.shard == k for r in rows) for k in range(16)]
        assert max(counts) - min(counts) <= 1
        for k in range(16):
            assert sorted(r.slot for r in rows if r.shard == k) == list(range(counts[k]))
    rows = SH.sharded(docs).collect()
    for source in {r.source for r in docs.collect()}:
        own = [sum(r.shard == k and r.source == source for r in rows) for k in range(16)]
        assert max(own) - min(own) <= 2
    assert SH.sharded(docs.limit(0)).count() == 0


def test_written_shards_hold_every_row(spark, docs, odd, tmp_path, monkeypatch):
    monkeypatch.setattr(SH, "FILE", 20)
    twins = spark.createDataFrame([(None, "t", "x", i % 3) for i in range(90)] + [(1, "t", None, 0)], "doc_id long, text string, source string, extra int")
    for k, frame in enumerate((docs, odd, twins)):
        SH.write_shards(frame, str(tmp_path / f"s{k}"), shards=4)
        back = spark.read.parquet(str(tmp_path / f"s{k}"))
        assert sorted(map(str, back.select(*[C.quoted(c) for c in frame.columns]).collect())) == sorted(map(str, frame.collect()))
        want = {r.shard: r["count"] for r in SH.sharded(frame, 4).groupBy("shard").count().collect()}
        assert {r.shard: r["count"] for r in back.groupBy("shard").count().collect()} == want
        assert back.groupBy("shard", "file").count().where("count > 20").isEmpty()


# 7


def brute_top(rows, k=5):
    kept = [(i, np.floor(256 * np.array(v, np.float64))) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(np.array(v, np.float64)).all()]
    width = max(len(v) for _, v in kept)
    ids, table = [i for i, _ in kept], np.array([np.pad(v, (0, width - len(v))) for _, v in kept]).astype(np.int64)
    out = []
    for i, v in zip(ids, table, strict=True):
        if i % 50 == 0:
            best = sorted((-int(s), j) for s, j in zip(table @ v, ids, strict=True) if j != i)[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    return sorted(out)


def test_search_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(VS, "BLOCK", 200)
    rng = np.random.default_rng(1)
    rows = [(i, list(map(float, rng.normal(size=8) * 0.2 + (i % 7)))) for i in range(1200)] + [(1200 + i, [0.5] * 8) for i in range(600)]
    rows += [(7200, [2e11, -1e11])]  # scores of more than 53 bits
    rows += [(7001, None), (7000, [1.0, None]), (7050, [float("nan")]), (None, [1.0]), (7100, [0.25, 2.0]), (7101, []), (7150, [3e30, 1.0])][:-1]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rep", F.lit(1))
    assert sorted(tuple(r) for r in VS.top_products(frame).collect()) == brute_top([tuple(r)[:2] for r in frame.collect()])
    assert VS.top_products(frame.limit(0)).count() == 0


# 8


def brute_base(text):
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{SS.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))


def brute_spans(text, scope=SS.SCOPE):
    base = [(int(a), SS.KINDS.index(k), int(b)) for k, a, b in (x.split(":") for x in brute_base(text).split(",") if x)]
    account = r"""(?<![a-z0-9_])(?:user(?:_?name)?|login|client_?id|account_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?[a-z0-9@._+-]{3,}"""
    endpoint = r"""(?:https?|postgres(?:ql)?|mysql|mongodb|redis|amqps?|s3|ftp)://[^\x20\x09-\x0D"'<>]+"""
    clear = lambda x: not any(b[0] < x[2] and x[0] < b[2] for b in base)
    near = lambda x, others: any(o[0] <= x[2] + scope and x[0] <= o[2] + scope for o in others)
    accounts = [x for x in ((m.start(), 3, m.end()) for m in re.finditer(account, text, re.I | re.A)) if clear(x)]
    randoms = [x for x in ((m.start(), 4, m.end()) for m in re.finditer(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}", text) if re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0])) if clear(x)]
    ids, keys = [b for b in base if b[1] == 1] + accounts, [b for b in base if b[1] != 1] + randoms
    ends = [x for x in ((m.start(), 5, m.end()) for m in re.finditer(endpoint, text)) if near(x, ids) and near(x, keys)]
    return sorted(base + [x for x in accounts if near(x, keys)] + [x for x in randoms if near(x, ids)] + ends)


def brute_mask(text):
    out, last = "", -1
    for start, _, end in brute_spans(text):
        if start > last:
            out += text[max(0, last) : start] + "[SECRET]"
        last = max(last, end)
    return out + text[max(0, last) :]


def test_added_spans_and_masks_equal_brute_force(spark, docs):
    rnd = random.Random(5)
    parts = ['token = "', "secret: token = abcdefgh1", "password=", "API_KEY:'", "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "cafe", " ", "\n", "é😀", "user: bob ", "login=anna ", "https://x.io/a", "abc", "=", "q" * 9, "Zx9" * 12, " . " * 60, "x" * 70 + "1", "s3://b/c "]
    made = [(i, "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40)))) for i in range(600)]
    made += [(9000, "token=abcdef1 " * 2000), (9001, "user: bob " + "é . " * 50 + "Zx9" * 12 + "".join(rnd.choice(parts) for _ in range(4000))), (9002, ""), (9003, "login=anna password=hunter22xx\n" * 3000)]
    for frame in (spark.createDataFrame(made, "doc_id long, text string").repartition(4), docs):
        texts = {r.doc_id: r.text or "" for r in frame.collect()}
        assert {r.doc_id: r.spans for r in SS.secrets(frame).collect()} == {i: ",".join(f"{SS.KINDS[k]}:{a}:{b}" for a, k, b in brute_spans(t)) for i, t in texts.items()}
        assert {r.doc_id: r.text or "" for r in SS.redacted(frame).collect()} == {i: brute_mask(t) for i, t in texts.items()}


def test_secrets_equal_brute_force(spark, docs, odd):
    rnd = random.Random(5)
    parts = ['token = "', "secret: token = abcdefgh1", "password=", "API_KEY:'", "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "cafe", " ", "\n", "é😀", "user: bob ", "https://x.io/a", "abc", "=", "q" * 9, "Zx9" * 12]
    made = spark.createDataFrame([(i, "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25)))) for i in range(600)] + [(9000, "token=abcdef1 " * 2000)], "doc_id long, text string")
    for frame in (made, docs, odd):
        texts = {(r.doc_id, brute_base(r.text or "")) for r in frame.collect()}
        got = SS.secrets(frame).collect()
        assert {(r.doc_id, r.base) for r in got} == texts
        assert all(set(r.base.split(",")) <= set(r.spans.split(",")) or not r.base for r in got)
        assert all(r.n_assign + r.n_access + r.n_hex == (len(r.base.split(",")) if r.base else 0) for r in got)


def test_weak_parts_need_their_complements(spark):
    key = "wJalrXUtnFEMIK7MDENGbPxRfiCYEXAMPLEKEY01"
    rows = [(1, f"nothing but {key} here"), (2, f"login=anna {key} at https://h.io/x"), (3, "login=anna and https://h.io/x"), (4, f"login=anna {'.' * 400} {key}")]
    got = {r.doc_id: r.spans for r in SS.secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == got[3] == got[4] == ""
    assert [s.split(":")[0] for s in got[2].split(",")] == ["account", "random", "endpoint"]


def test_redaction_leaves_no_secret(spark, odd):
    rows = spark.createDataFrame([(1, "a token = abcdef12 b", 0), (2, "clean", 5), (3, None, None), (4, "password=aaaaaaaa0123456789abcdef01234567 x", 0)], "doc_id long, text string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in SS.redacted(rows).collect()}
    assert got == {1: ("a [SECRET] b", 12), 2: ("clean", 5), 3: (None, None), 4: ("[SECRET] x", 10)}
    masked = SS.redacted(odd)
    assert masked.columns == odd.columns
    same = [c for c in odd.columns if c not in ("text", "n_chars")]
    tell = lambda frame: sorted(str([r[c] for c in same]) for r in frame.collect())
    assert tell(masked) == tell(odd) and not any("abcdef1" in (r.text or "") for r in masked.collect())
    assert SS.redacted(odd.limit(0)).count() == 0


def test_stages_keep_all_columns(spark, odd):
    """Columns of any name come through with their values."""
    tell = lambda frame: {str([(c, r[c]) for c in odd.columns if c != "text"]) for r in frame.collect()}
    for out in (M.mix(odd), ND.without_near_duplicates(odd)):
        assert out.columns == odd.columns and tell(out) <= tell(odd)


# 9


def test_entropies_and_neighbourhoods():
    import collections
    import math

    rnd = random.Random(1)
    data = bytes(rnd.choice(b"aabcd \n") for _ in range(300))
    want = [-sum(c / 64 * math.log2(c / 64) for c in collections.Counter(data[i : i + 64]).values()) for i in range(237)]
    assert np.abs(FP.entropies(np.frombuffer(data, np.uint8)) - want).max() < 1e-4
    x = np.array([rnd.randrange(50) for _ in range(200)], np.int64)
    assert list(FP.least_within(x, 16)) == [min(x[max(0, i - 16) : i + 17]) for i in range(200)]


def spark_hash(text):
    import xxhash

    return int(np.uint64(xxhash.xxh64(text.encode(), seed=42).intdigest()).astype(np.int64))


def brute_digest(text):
    """Window size -> filters, each a set of bits: by plain Python, one window at a time."""
    import collections
    import math

    table = [int(x) for x in C._BYTE]
    radix, full = C._RADIX, (1 << 64) - 1

    def mixed(x):
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = ((x ^ x >> shift) * factor) & full
        return x ^ x >> 31

    out = {}
    for window, reach, typical, below in ((64, 16, 4.0, 1 << 62), (16, 4, 3.3, 1024), (4, 1, 1.8, 256), (2, 0, 1.0, 64), (1, 0, 0.0, 8)):
        if not window <= len(text) < below:
            continue
        keys, hashes = [], []
        for i in range(len(text) - window + 1):
            part = text[i : i + window]
            hashes.append(mixed(sum(table[b] * pow(radix, k, 1 << 64) for k, b in enumerate(part)) & full))
            # n log n in steps of 1 / 4096, as a table of whole numbers has it
            total = sum(round(n * math.log2(n) * 4096) for n in collections.Counter(part).values())
            entropy = math.log2(window) - total / (4096 * window)
            rank = 1 << 20 if entropy < 1 else (1 << 19) - int(min(abs(entropy - typical) * 4096, (1 << 19) - 1))
            keys.append((rank, hashes[-1] >> 32))
        found = []
        for i, key in enumerate(keys):
            if key == min(keys[max(0, i - reach) : i + reach + 1]) and hashes[i] not in found:
                found.append(hashes[i])
        out[window] = [{(h >> 11 * k) % 2048 for h in found[j : j + 128] for k in range(5)} for j in range(0, len(found), 128)]
    return out


def brute_likeness(a, b):
    if not a or not b:
        return float(len(a) == len(b))
    top = bottom = 0.0
    for window in a.keys() & b.keys():
        short, long = sorted((a[window], b[window]), key=len)
        for x in short:
            best = 0.0
            for y in long:
                chance, most = len(x) * len(y) / 2048, min(len(x), len(y))
                best = max(best, min(1.0, (len(x & y) - chance) / max(1e-9, most - chance)))
            top, bottom = top + best * len(x), bottom + len(x)
    return top / max(1.0, bottom)


def test_digests_equal_brute_force(docs):
    rnd = random.Random(8)
    texts = [r.text.encode() for r in docs.limit(40).collect() if r.text and len(r.text) < 2500]
    texts += [bytes(rnd.choice(b"abcdefgh  \n0") for _ in range(rnd.choice([1, 2, 3, 7, 8, 20, 63, 64, 65, 255, 256, 300, 1023, 1024, 1500]))) for _ in range(40)]
    ours = [FP.digest(f) for f in FP.features(texts)]
    brute = [brute_digest(t) for t in texts]
    for a, b in zip(ours, brute, strict=True):
        assert {w: [set(np.flatnonzero(row).tolist()) for row in x] for w, x in a.items()} == b
    for i in range(0, len(texts) - 1):
        assert abs(FP.likeness(ours[i], ours[i + 1]) - brute_likeness(brute[i], brute[i + 1])) < 1e-6


def test_fingerprints_equal_one_by_one(spark, docs, odd):
    for frame in (docs, odd):
        rows = sorted(((r.doc_id, r.text or "") for r in frame.collect()), key=lambda r: (r[0] is not None, r[0] or 0, spark_hash(r[1])))
        prints = [FP.digest(FP.features([t.encode()])[0]) for _, t in rows]
        want = []
        for k, (i, own) in enumerate(rows):
            following, half = rows[(k + 1) % len(rows)][1], len(own) // 2
            edited = (own[: len(own) - half] + following[:half]).encode()
            changed = FP.digest(FP.features([edited])[0])
            want.append((str(i), len(own), hashlib.sha256(edited).hexdigest(), FP.as_text(prints[k]), FP.as_text(changed), round(FP.likeness(prints[k], changed), 9), round(FP.likeness(prints[k], prints[(k + 1) % len(rows)]), 9)))
        got = [(str(r.doc_id), r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9)) for r in FP.fingerprints(frame.repartition(5)).collect()]
        assert sorted(got) == sorted(want)
    assert FP.fingerprints(docs.limit(0)).count() == 0


def test_likeness_orders_texts():
    rnd = random.Random(2)
    words = lambda: " ".join("".join(rnd.choice("abcdefghij") for _ in range(6)) for _ in range(600))
    a, b = words(), words()
    half = a[: len(a) // 2] + b[: len(b) // 2]
    one, other, mixed = (FP.digest(f) for f in FP.features([a.encode(), b.encode(), half.encode()]))
    assert FP.likeness(one, one) == 1 and FP.likeness(one, other) < 0.1 and 0.25 < FP.likeness(one, mixed) < 0.75


def test_likeness_of_short_texts(spark):
    """Half of each text is kept: it is more like its edited text than like the next, whatever its length."""
    rnd = random.Random(4)
    made = ["".join(rnd.choice("abcdefghijklmnopqrst uvwxyz") for _ in range(n)) for n in range(4, 130) for _ in range(3)]
    made += ["".join(rnd.choice("一二三四五六七八九十") for _ in range(n)) for n in range(2, 40)]
    rnd.shuffle(made)
    frame = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    rows = [r for r in FP.fingerprints(frame).collect() if r.doc_id < len(made) - 1]
    assert all(r.near_edited > 0 for r in rows)
    assert sum(r.near_edited > r.near_next for r in rows) >= 0.97 * len(rows)
    a = b"one short text of under 64 bytes"
    one, other = (FP.digest(f) for f in FP.features([a, a.replace(b"short", b"shost")]))
    assert FP.likeness(one, one) == 1 and FP.likeness(one, other) > 0.4


# 10


def test_quality_on_held_out_rows(spark, sf_dir, odd):
    base = "/root/testdata/sf0.01"
    documents, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    scores = QL.quality_scores(documents, labels)
    rows = scores.join(labels, "doc_id").where("held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    good = [r.predicted == r.quality for r in rows]
    assert sum(good) >= 0.95 * len(good)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert QL.quality_scores(odd, labels).count() == len(ODD)
    kept = QL.accepted(odd, labels)
    assert kept.columns == odd.columns
    none = labels.limit(0)
    assert {r.predicted for r in QL.quality_scores(odd, none).collect()} == {1}
    assert QL.quality_scores(documents.limit(0), labels).count() == 0


def test_fitting_takes_one_text_of_an_id(spark):
    made = [(i % 40, ("good text here " if i % 2 else "BAD!! ## ") + str(i // 400)) for i in range(2000)]
    documents = spark.createDataFrame(made, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    rows = QL.learnt_rows(documents, labels, 16_384).collect()
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 3 != 1]
    assert len(rows) == len(ids)


def test_descent_closes_the_duality_gap():
    """The dual value that descent ends at is near the primal one, so the weights are near the best ones."""
    rng = np.random.default_rng(3)
    rows = [np.unique(rng.integers(0, 60, 12)) for _ in range(150)]
    labels = np.where([r.min() < 4 for r in rows], 1.0, -1.0)
    ratio = rng.normal(size=60)
    weights, alpha = QL.solved(rows, labels, ratio, passes=400)
    values = [ratio[r] / np.sqrt((ratio[r] ** 2).sum()) for r in rows]
    margin = np.array([labels[i] * (weights[r] @ v + weights[-1]) for i, (r, v) in enumerate(zip(rows, values, strict=True))])
    primal = 0.5 * (weights**2).sum() + QL.COST * np.maximum(0, 1 - margin).sum()
    dual = alpha.sum() - 0.5 * (weights**2).sum()
    assert 0 <= primal - dual < 0.01 * primal


def test_descent_separates():
    rows = [np.array([0, 2]), np.array([0, 3]), np.array([1, 2]), np.array([1, 3])]
    labels = np.array([1.0, 1.0, -1.0, -1.0])
    weights = QL.descent(rows, labels, np.array([1.0, -1.0, 0.1, -0.1]))
    values = np.array([1.0, -1.0, 0.1, -0.1])
    assert all(np.sign((values[r] * weights[r]).sum() + weights[-1]) == y for r, y in zip(rows, labels, strict=True))


# the pipeline


def test_pipeline_stages(spark):
    import corpus_pipeline

    base = "/root/testdata/sf0.01"
    documents = spark.read.parquet(f"{base}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{base}/labels.parquet").collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "secrets", "mixing", "pieces"]
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality"](spark, documents, base).cache()
    known = [labels[r.doc_id] for r in kept.collect() if r.doc_id in labels]
    assert sum(known) >= 0.97 * len(known)
    single = stages["near_duplicates"](spark, kept, base).cache()
    groups = brute_groups([(r.doc_id, r.text) for r in kept.collect()], 80)
    assert {r.doc_id for r in single.collect()} == {i for i, g in groups.items() if g[2]}
    clean = stages["secrets"](spark, single, base).cache()
    assert clean.count() == single.count() and clean.where("text rlike 'token = \"[0-9a-f]{24,}'").isEmpty()
    mix = stages["mixing"](spark, clean, base).cache()
    assert mix.columns == documents.columns
    empty = documents.limit(0)
    for stage in stages.values():
        assert stage(spark, empty, base).count() == 0
    odd_rows = spark.createDataFrame([(*r, r[2], None) for r in ODD], documents.select("doc_id", "text", "lang", "source", "n_chars").schema)
    for name in names:
        odd_rows = stages[name](spark, odd_rows, base).cache()
    assert odd_rows.where("not round_trip").isEmpty()
    out = stages["pieces"](spark, mix, base)
    assert out.count() == mix.count() and out.where("not round_trip").isEmpty()


def anonymous_mb() -> float:
    with open("/proc/self/smaps_rollup") as f:
        return sum(int(n) for n in re.findall(r"\nAnonymous:\s+(\d+)", f.read())) / 1024


def test_worker_gives_memory_back_when_its_task_is_over():
    """Small arrays below one that stays: their memory is free, but an allocator keeps it until it is asked."""
    stays = []

    def work(batches):
        for n in batches:
            small = [np.ones(12_000) for _ in range(n)]
            stays.append(np.ones(12_000))
            yield len(small)
            del small
            yield anonymous_mb()

    sizes = list(C.tidy(work)(iter([1_500])))
    assert sizes[0] == 1_500 and anonymous_mb() < sizes[1] - 80
    short = C.tidy(work)(iter([1, 1]))
    assert next(short) == 1
    short.close()


def test_pieces_remember_words_that_come_again():
    import sentencepiece

    machine, library = PT.PieceTransducer(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    choice = random.Random(5)
    often = ["often", "again", "Wörter", "and"]
    text = " ".join("".join(choice.choices("abcdefgh", k=9)) if i % 2 else often[i // 2 % 4] for i in range(8_000))
    for _ in range(2):
        assert np.frombuffer(machine.encode(text[: len(text) // 2]), np.int32).tolist() == library.encode(text[: len(text) // 2])
        text = text[len(text) // 2 :] * 2
    assert set(often) <= set(machine.spaced)
    assert len(machine) + len(machine.spaced) < 100


def test_no_links_without_python_workers(spark):
    level = spark.range(1).select("id", F.lit(1).cast("long").alias("n"), F.array(F.lit(7).cast("long")).alias("members"), F.lit(None).cast("long").alias("component"))
    found = ND.long_band_links(level, 80, lambda df: df)
    assert found.dtypes == [(c, "bigint") for c in ("u", "v", "both", "n_u", "n_v")] and found.count() == 0
    assert "ExistingRDD" not in found._jdf.queryExecution().toString()


def test_fingerprints_of_rows_in_changing_order(spark):
    """Input whose rows come in another order each time they are computed: no row may be lost or doubled."""
    base = spark.range(1000).select(F.when(F.col("id") % 7 > 0, F.col("id") % 400).alias("doc_id"), F.concat(F.lit("text number "), (F.col("id") % 200).cast("string")).alias("text"))

    def shuffled(batches):
        import pyarrow as pa

        for batch in batches:
            yield batch.take(pa.array(np.random.default_rng().permutation(batch.num_rows)))

    unstable = base.repartition(8).mapInArrow(shuffled, "doc_id long, text string")
    found = FP.fingerprints(unstable).collect()
    assert len(found) == 1000
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r.doc_id) for r in base.collect())
    assert sorted(map(str, FP.fingerprints(base).collect())) == sorted(map(str, found))


def test_fingerprints_of_equal_rows_and_the_least_id(spark):
    rows = [(-(1 << 63), "least id of all"), (None, "no id"), *[(5, "the same text")] * 200, (6, "the last one")]
    found = FP.fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert len(found) == 203 and {r.doc_id for r in found} == {None, -(1 << 63), 5, 6}
    own = [r for r in found if r.doc_id == 5]
    assert sum(r.near_next == 1 for r in own) == 199 and len({r.edited_sha256 for r in own}) == 2


def test_urls_of_equal_rows(spark):
    """Very many rows alike, with a null id: each keeps its row."""
    pages = spark.range(50_000).select(F.lit(None).cast("long").alias("page_id"), F.lit("http://a.example.net/en/x").alias("url"))
    found = UF.judged(pages, UF.rules_frame(spark, queries.URL_RULES)).groupBy("page_id", "host", "path", "rule", "verdict").count().collect()
    assert [tuple(r) for r in found] == [(None, "a.example.net", "/en/x", "example.net/en/", "allow", 50_000)]


def test_search_of_one_vector_that_many_rows_share(spark):
    rows = [(k, [1.0, 2.0]) for k in range(0, 3000)] + [(k, [float(k % 7), 1.0]) for k in range(3000, 3300)]
    found = VS.top_products(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert sorted(map(tuple, found)) == sorted(brute_top(rows))


def test_quality_of_one_class_and_of_contradicting_labels(spark):
    docs = spark.createDataFrame([(k, f"text number {k}") for k in range(60)], "doc_id long, text string")
    one = spark.createDataFrame([(k, 1) for k in range(60)], "doc_id long, quality int")
    both = one.union(one.withColumn("quality", F.lit(0)))
    assert {r.predicted for r in QL.quality_scores(docs, one).collect()} == {1}
    assert {r.score for r in QL.quality_scores(docs, both).collect()} == {0.5}


def test_accepted_sends_only_texts_to_python(spark):
    documents, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    kept = QL.accepted(documents, labels)
    plan = kept._jdf.queryExecution().toString()
    assert "MapInArrow" not in plan and "ArrowEvalPython [good(text#" in plan
    scores = {r.doc_id: r.predicted for r in QL.quality_scores(documents, labels).collect()}
    assert sorted(kept.toPandas().doc_id) == sorted(k for k, v in scores.items() if v == 1)
    assert kept.join(documents, documents.columns).count() == kept.count()


def test_long_bands_leave_buckets_whose_centres_are_all_done(spark):
    # three sets of 1,000 members, 900 of which all have: no two are linked at 85, and all meet in long bands
    rng = np.random.default_rng(7)
    common, own = rng.integers(0, 1 << 63, 900, np.uint64) * 2, rng.integers(0, 1 << 63, (3, 100), np.uint64) * 2
    rows = [(k, 1000, np.sort(np.concatenate([common, own[k]])).view(np.int64).tolist(), k) for k in range(3)]
    level = spark.createDataFrame(rows, "id long, n long, members array<long>, component long")
    rounds, keep = [], C.Scratch(spark)

    def kept(df):
        out = keep(df)
        if "lows" in df.columns and "id" in df.columns:
            rounds.append(out.count())
        return out

    assert ND.long_band_links(level, 85, kept).count() == 0
    assert len(rounds) == 2 and all(rounds)  # one centre, then all: no round for an empty rest
    keep.drop()


def test_long_bands_drop_members_that_fit_no_low_set(spark):
    """One text in sets of several sizes: what fits no other component's low set by size leaves before the first round."""
    rng = np.random.default_rng(3)
    common = np.sort(rng.integers(0, 1 << 63, 2_000, np.uint64) * 2).view(np.int64)

    def row(k, n, size, component):
        return k, n, common[:size].tolist(), component

    # 2 and 3 are low and near in size but of one component, 4 and 5 have too many members of their own for any of them
    rows = [row(2, 1000, 1000, 2), row(3, 1010, 1000, 2), row(4, 1400, 1000, 4), row(5, 1400, 1000, 5), row(6, 2000, 2000, 6), row(7, 2000, 1990, 7)]
    # an open group that has the number of a component is still compared with that one
    rows += [row(8, 500, 500, None), row(9, 505, 500, 8)]
    level = spark.createDataFrame(rows, "id long, n long, members array<long>, component long")
    rounds, keep = [], C.Scratch(spark)

    def kept(df):
        out = keep(df)
        if "lows" in df.columns and "id" in df.columns:
            rounds.append({r.id for r in out.select("id").distinct().collect()})
        return out

    found = {(r.u, r.v) for r in ND.long_band_links(level, 85, kept).collect()}
    assert found == {(6, 7), (8, 9)}
    assert rounds[0] == {6, 7, 8, 9}
    keep.drop()


def test_pieces_judge_only_the_arcs_that_are_taken(monkeypatch):
    import sentencepiece

    machine, library = PT.PieceTransducer(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    choice, judged, beside = random.Random(8), [], machine.table.beside
    monkeypatch.setattr(machine.table, "beside", lambda a, b: judged.append((a, b)) or beside(a, b))
    words = ["".join(choice.choices("etaoinshrdlué漢\x01", k=choice.randrange(1, 14))) for _ in range(3_000)]
    ids = [np.frombuffer(machine.path(PT.SPACE + w), np.int32).tolist() for w in words]
    assert ids == [library.encode(w) for w in words]
    # neighbours are judged once each; judging all arcs took 0.64 times the ids, those taken 0.52
    assert len(judged) < 0.58 * sum(map(len, ids))


def test_sets_are_in_the_long_bands_that_their_members_need(spark):
    """A linked pair shares no band with probability 1e-10 at most, whatever its sizes, and sets with shingles of their own take few bands."""
    rng = np.random.default_rng(9)
    for similarity in (80, 85):
        n = rng.integers(20, 3_000, (2, 20_000))
        least = -(-similarity * n.sum(axis=0) // (100 + similarity))  # what linked sets have in common
        n, least = n[:, least <= n.min(axis=0)], least[least <= n.min(axis=0)]
        m = rng.integers(least, n + 1)
        both = rng.integers(least, m.min(axis=0) + 1)
        shared = np.minimum(*(ND.own_bands(n[k], m[k], similarity) for k in range(2)))
        alike = both / (m.sum(axis=0) - both)
        assert len(both) > 1_000 and ((1 - alike**ND.LONG) ** shared < 1.001e-10).all()
        assert ND.own_bands(np.array([500, 1000, 1000]), np.array([500, similarity * 10, similarity * 10 - 1]), similarity).tolist() == [ND.long_bands(similarity), 1, 0]

    # edits of one text, each with shingles of its own, a tenth of them linked with an edit that has few
    common = np.sort(rng.integers(0, 1 << 63, 1_000, np.uint64) * 2).view(np.int64)
    sets = [np.delete(common, rng.choice(1_000, size, replace=False)) for size in [70] * 90 + [20] * 10]
    rows = [(k, 1_000, x.tolist(), k) for k, x in enumerate(sets)]
    level, made, keep = spark.createDataFrame(rows, "id long, n long, members array<long>, component long"), [], C.Scratch(spark)

    def kept(df):
        out = keep(df)
        if df.columns == ["bucket", "id"] or "lows" in df.columns and "id" in df.columns:
            made.append(out.count())
        return out

    found = {(r.u, r.v) for r in ND.long_band_links(level, 80, kept).collect()}
    linked = [(a, b) for a, b in itertools.combinations(range(100), 2) if 180 * len(np.intersect1d(sets[a], sets[b])) >= 160 * 1_000]
    assert linked and found <= set(linked)
    roots = []
    for edges in (found, linked):
        group = list(range(100))
        for a, b in edges:
            group = [min(group[a], group[b]) if g in (group[a], group[b]) else g for g in group]
        roots.append(group)
    assert roots[0] == roots[1]
    assert made[0] < 0.6 * ND.long_bands(80) * len(rows)  # all sets were in all bands
    keep.drop()


def test_long_bands_make_no_pairs_that_cells_rule_out(spark):
    """Edits of one text in different places, all of them near enough by size: hardly a pair is made, and the linked ones are found."""
    rng = np.random.default_rng(10)
    common = np.sort(rng.integers(0, 1 << 63, 1_000, np.uint64) * 2).view(np.int64)
    gone = [rng.choice(1_000, 100, replace=False) for _ in range(40)]
    gone += [np.concatenate([gone[0][:95], np.setdiff1d(np.arange(1_000), gone[0])[:5]])]  # linked with the first
    rows = [(k, 1_000, np.delete(common, x).tolist(), k) for k, x in enumerate(gone)]
    level, made, keep = spark.createDataFrame(rows, "id long, n long, members array<long>, component long"), [], C.Scratch(spark)

    def kept(df):
        out = keep(df)
        if df.columns == ["u", "v", "n_u", "n_v"]:
            made.append(out.count())
        return out

    assert {(r.u, r.v) for r in ND.long_band_links(level, 80, kept).collect()} == {(0, 40)}
    assert 1 <= sum(made) < 80  # of 820 that are near enough by size
    keep.drop()
