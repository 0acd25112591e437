"""Operators 11 to 13 against brute force and on odd rows."""

import hashlib
import itertools
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import filter_audit as FA
from tallyframe.llm import lang_crf as LC
from tallyframe.llm import merkle as MK

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
ODD = [
    (None, None, None, None, None), (None, "s", "de", 3, "ohne id"), (None, "s", "de", 3, "ohne id"), (1, None, "en", 0, None), (2, "", "en", 0, ""), (3, "s", "en", 3, " \n\t"),
    (4, "s", "en", 3, "A b"), (4, "s", "en", 3, "A b"), (4, "t", "en", 3, "other TEXT"), (5, "s", "", 9, "é😀 \x00 日本 $%"), (6, "s", "fr", 9, "Mot ET " * 20_000), (7, "s", None, 9, "ab1é" * 20_000), (8, "s", "zz", 1, "12345 !!"),
]


@pytest.fixture(scope="module")
def odd(spark):
    """With extra columns whose names the operators use inside."""
    names = ("key", "id", "leaf", "changed", "at", "of", "block", "path", "digest", "mask", "n", "part", "words", "first", "d", "quality", "toxic", "total", "step", "letter", "place", "held_out", "a.b `c", "range", "before", "copy")
    return spark.createDataFrame(ODD, SCHEMA).withColumns({c: F.lit(7) for c in names}).repartition(3)


# 11


def test_chains_equal_all_paths(monkeypatch):
    monkeypatch.setattr(LC, "CHUNK", 3)
    rng = np.random.default_rng(1)
    lengths = (1, 2, 0, 3, 7, 8)
    at = np.concatenate([[0], np.cumsum(lengths)])
    scores, moves = rng.normal(size=(at[-1], 3)) * 3, rng.normal(size=(3, 3))
    found = LC.posteriors(*LC.Chain(scores, at, moves).run())
    for a, b in itertools.pairwise(at):
        own = np.zeros((b - a, 3))
        for path in itertools.product(range(3), repeat=b - a):
            weight = np.exp(sum(scores[a + i, x] for i, x in enumerate(path)) + sum(moves[x, y] for x, y in itertools.pairwise(path)))
            for i, x in enumerate(path):
                own[i, x] += weight
        assert np.allclose(found[a:b], own / own.sum(axis=1, keepdims=True))


def test_pieces_of_a_text_give_what_the_whole_does(monkeypatch):
    rng = np.random.default_rng(2)
    model = LC.Model(["a", "b"], rng.normal(size=(2, 1 << LC.BITS)), np.zeros(1 << LC.LEXICON_BITS, np.int32), np.zeros((7, 2)), rng.normal(size=(2, 2)))
    for text in ("wort und word " * 900, "123 " * 2000 + "wort", "x" * 9000, "12 " * 3000):
        data = np.frombuffer(text.encode(), np.uint8)
        at = np.array([0, len(data)])
        whole = LC.shares(data, at, model)
        monkeypatch.setattr(LC, "PIECE", 1000)
        parts = LC.pieces(data)
        assert b"".join(p.tobytes() for p in parts) == text.encode() and len(parts) > 8
        if " " in text:
            assert np.allclose(LC.shares(data, at, model), whole)
        monkeypatch.undo()


def test_fitting_lowers_the_likelihood_loss():
    """On a small part the fitted chain must explain its labels better than equal weights, and learn to stay."""
    rng = random.Random(3)
    texts = [" ".join(rng.choice(("der", "die", "und", "ein") if k % 2 else ("the", "and", "one", "of")) for _ in range(8)).encode() for k in range(40)]
    words = LC.words_of(np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
    model = LC.fit(words, np.arange(40) % 2, 2, np.zeros(1 << LC.LEXICON_BITS, np.int32))
    model.langs = ["en", "de"]
    p = LC.posteriors(*LC.Chain(model.emissions(words), words.of, model.moves).run())
    truth = np.repeat(np.arange(40) % 2, np.diff(words.of))
    assert (p.argmax(axis=1) == truth).all() and p[np.arange(len(p)), truth].mean() > 0.95
    assert model.moves[0, 0] > model.moves[0, 1] and model.moves[1, 1] > model.moves[1, 0]


def test_languages_of_held_out_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = LC.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    for row in rows:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1) and 0 <= row.score <= 1
    held = [row for row in rows if row.held_out]
    assert sum(row.lang_pred == row.lang for row in held) >= 0.95 * len(held)


def test_held_out_labels_have_no_effect(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    changed = docs.withColumn("lang", F.when(LC.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang"))).withColumn("source", F.lit("other"))
    assert sorted(LC.languages(docs).collect()) == sorted(LC.languages(changed).collect())


def test_languages_of_odd_rows(spark, odd):
    rows = LC.languages(odd).collect()
    assert len(rows) == len(ODD)
    langs = {r[2] for r in ODD} - {None}
    for row in rows:
        text = {r[0]: r[4] for r in ODD}.get(row.doc_id)
        if row.doc_id in (1, 2, 3, 8):
            assert (row.lang_pred, row.score) == ("und", 0.0), text
        elif row.doc_id is not None:
            assert row.lang_pred in langs and 0 < row.score <= 1
    none = spark.createDataFrame([], SCHEMA)
    assert LC.languages(none).count() == 0
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in LC.languages(unlabelled).collect()} == {("und", 0.0)}


def test_spans_of_code_switched_text(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = LC.fitted(docs)
    words = {lang: docs.where((F.col("lang") == lang) & (F.length("text") > 400)).orderBy("doc_id").first().text[:300].rsplit(" ", 1)[0] for lang in ("en", "fr")}
    mixed = f"{words['en']} {words['fr']}"
    spans = LC.language_spans(spark.createDataFrame([(1, mixed), (2, None), (3, "12")], "doc_id long, text string"), model).orderBy("start").collect()
    assert {s.doc_id for s in spans} == {1}
    raw = mixed.encode()
    for lang, text in words.items():
        own = sum(len(raw[s.start : s.end]) for s in spans if s.lang == lang)
        assert own > 0.8 * len(text.encode())
    assert all(raw[s.start : s.end].decode() for s in spans)


# 12


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute_manifest(rows):
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of each row, one by one."""

    def leaf(row):
        return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row))

    def up(nodes):
        return [sha("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)]

    def walk(nodes, at, own):
        others = ""
        while len(nodes) > 1:
            run = nodes[at // 8 * 8 : at // 8 * 8 + 8]
            others += "".join(x for i, x in enumerate(run) if i != at % 8)
            run[at % 8] = own
            own, nodes, at = sha("".join(run)), up(nodes), at // 8
        return own, others

    groups = defaultdict(list)
    for row in rows:
        doc_id, text = row[0], row[4]
        tampered = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 and text is not None
        changed = leaf((*row[:4], lower(text))) if tampered else None
        groups[row[2]].append((doc_id is not None, doc_id or 0, leaf(row), changed or "", row))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    tops = []
    for name in names:
        groups[name].sort(key=lambda x: x[:4])
        nodes = [x[2] for x in groups[name]]
        while len(nodes) > 1:
            nodes = up(nodes)
        tops.append(nodes[0])
    root = tops
    while len(root) > 1:
        root = up(root)
    out = []
    for k, name in enumerate(names):
        leaves = [x[2] for x in groups[name]]
        for i, (_, _, own, changed, row) in enumerate(groups[name]):
            folded, others = walk(leaves, i, changed or own)
            folded, more = walk(tops, k, folded)
            out.append((row[0], own, tops[k], root[0], sha(others + more), folded, folded == root[0], name))
    return out


@pytest.mark.parametrize("height", [1, 4])
def test_manifest_equals_brute_force(spark, odd, height):
    """Also with blocks of 8 leaves, so that blocks above blocks are needed."""
    rng = random.Random(height)
    rows = [*ODD, *((k, "s", rng.choice(["de", "en", "en", "en", None, f"l{k % 30}"]), k, f"Text {k} {'Q' * (k % 3)}") for k in range(100, 700))]
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit(1)).repartition(5)
    found = [tuple(r) for r in MK.document_manifest(frame, height).collect()]
    assert sorted(found, key=repr) == sorted(brute_manifest(rows), key=repr)
    assert sorted((tuple(r) for r in MK.document_manifest(odd, height).collect()), key=repr) == sorted(brute_manifest(ODD), key=repr)


def test_versions_share_all_but_ancestors(spark):
    rows = [(k, "s", "en" if k % 5 else "de", k, f"Text {k}") for k in range(300)]
    frame = spark.createDataFrame(rows, SCHEMA)
    tree = MK.manifest(MK.document_rows(frame), height=1)
    changed = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 == 0]
    nodes = tree.versions().collect()
    assert {n.id for n in nodes} == {r[0] for r in changed}
    # English leaves: 240, 30, 4, 1, then the root over two subroots; German: 60, 8, 1
    assert Counter(n.id for n in nodes) == {r[0]: 5 if r[2] == "en" else 4 for r in changed}
    folded = {r.id: r.folded_root for r in tree.proofs().collect()}
    for n in nodes:
        if n.level == (4 if n.key == "=en" else 3):
            assert n.digest == folded[n.id] and n.node is None
        else:
            assert n.node == n.at // 8**n.level


def test_manifest_of_one_row_and_of_none(spark):
    assert MK.document_manifest(spark.createDataFrame([], SCHEMA)).count() == 0
    row = MK.document_manifest(spark.createDataFrame([(3, "s", "en", 1, "a")], SCHEMA)).first()
    assert row.leaf == row.subroot == row.root and row.proof_sha256 == sha("")


# 13


def brute_audit(rows, labels):
    parts = defaultdict(list)
    least = {}
    for doc_id, _, _, _, text in rows:
        if doc_id is not None:
            least[text or ""] = min(least.get(text or "", doc_id), doc_id)
    for doc_id, source, _, _, text in rows:
        text = text or ""
        words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w]
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text), "D": any(c in "#$%&*|" for c in text), "E": text in least and (doc_id is None or doc_id > least[text])}
        marks = [x for x in labels if x[0] == doc_id and doc_id is not None]
        parts[source or ""].append(({f for f, x in fails.items() if x}, any(m[1] == 1 for m in marks), any(m[2] == 1 for m in marks)))
    out = []
    for part, own in parts.items():
        removed = Counter()
        lines = []
        for order in itertools.permutations("ABCDE"):
            gone = set()
            for step, f in enumerate(order, 1):
                here = [x for x in own if f in x[0] and not x[0] & gone]
                removed[f] += len(here)
                lines.append((part, "".join(order), step, sum(not x[0] & (gone | {f}) for x in own), len(here), sum(f in x[0] for x in own) - len(here), sum(x[0] == {f} for x in own), sum(x[1] for x in here), sum(x[2] for x in here), f))
                gone.add(f)
        out.extend((*line[:-1], removed[line[-1]]) for line in lines)
    return out


def test_audit_equals_brute_force(spark, odd):
    rng = random.Random(5)
    words = ["a", "B", "c#", "dd", "E"]
    pool = [" ".join(rng.choice(words) if rng.random() < 0.5 else str(k) for k in range(rng.choice([1, 50, 199, 200, 400]))) for _ in range(60)]
    rows = [*ODD, *((rng.choice([None, *range(100)]), rng.choice(["s", "t", "", None]), "en", 1, rng.choice(pool)) for _ in range(300))]
    labels = [*((k, k % 2, k % 3 == 0) for k in range(60)), (1, 1, 0), (1, 0, 1), (None, 1, 1), (7, None, None), (8, 2, 5)]
    labels = [(a, None if b is None else int(b), None if c is None else int(c)) for a, b, c in labels]
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = FA.filter_audit(spark.createDataFrame(rows, SCHEMA).repartition(4), frame).collect()
    assert sorted(map(tuple, found)) == sorted(brute_audit(rows, labels))
    assert sorted(map(tuple, FA.filter_audit(odd, frame).collect())) == sorted(brute_audit(ODD, labels))
    assert FA.filter_audit(spark.createDataFrame([], SCHEMA), frame).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_forms_are_the_mean_of_all_orders(n):
    """The least-squares solution equals the mean marginal value over all orders, exactly."""
    rng = random.Random(n)
    value = [0, *(rng.randrange(1000) for _ in range((1 << n) - 1))]
    forms = FA.shapley_forms(n)
    for f in range(n):
        total = Fraction(0)
        orders = list(itertools.permutations(range(n)))
        for order in orders:
            before = sum(1 << g for g in order[: order.index(f)])
            total += value[before | 1 << f] - value[before]
        assert sum(x * v for x, v in zip(forms[f], value, strict=True)) == total / len(orders)


def test_other_filters_may_be_audited(spark):
    frame = spark.createDataFrame([(1, "s", "en", 1, "a b"), (2, "s", "en", 1, "a")], SCHEMA)
    labels = spark.createDataFrame([(2, 1, 0)], "doc_id long, quality int, toxic int")
    filters = {"x": lambda text, words: F.size(words) < 2, "y": lambda text, words: F.contains(text, F.lit("b"))}
    rows = FA.filter_audit(frame, labels, filters).collect()
    assert sorted((r.filter_order, r.step, r.kept, r.removed, r.good_lost, r.shapley) for r in rows) == [("xy", 1, 1, 1, 1, 2), ("xy", 2, 0, 1, 0, 2), ("yx", 1, 1, 1, 0, 2), ("yx", 2, 0, 1, 1, 2)]
