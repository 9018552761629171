"""Decontamination, SimHash groups and line deduplication against plain versions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from veritab.llm import decontamination, line_dedup, simhash
from veritab.llm.queries import QUERIES

DOCS = "doc_id bigint, text string, n_words int, items string"
ODD = [None, "", " ", "\n\n", "one", "Ünïcode ÉCOLE école", "a b c d e f g h i j k l m", "x" * 50_000,
       "word " * 3000, "tab\there\x0bvt\x0cff\rcr"]


@pytest.fixture(scope="module")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def rows_of(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


# -- decontamination

def test_decontamination_on_the_tables(spark, sf, documents):
    docs = rows_of(documents, "doc_id", "text")
    items = rows_of(spark.read.parquet(f"{sf}/benchmark.parquet"), "item_id", "text")
    want = {d: v for (d, _), v in brute.op4(docs, items).items()}
    got = QUERIES["op4_decontamination"](spark, sf).collect()
    assert len(got) == len(docs) and any(r["contaminated"] for r in got)
    for r in got:
        n, hit, found = want[r["doc_id"]]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == (
            n, hit, len(found), brute.sha(found), hit > 0)


def test_decontamination_edges(spark):
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi"
    items = [(1, base), (2, "short item here"), (2, "ALPHA beta"), (None, "null id words"), (4, None), (5, ""),
             (10, base + " extra"), (3, "one")]
    docs = [(i, t) for i, t in enumerate(ODD)] + [
        (20, "before, " + base.upper() + ". after"), (20, "before, " + base.upper() + ". after"),
        (21, " ".join(base.split()[:9])), (22, " ".join(base.split()[3:13]) + " short ITEM here alpha-beta"),
        (None, "null id words and " + base), (None, "clean"), (23, (base + " ") * 40), (23, "other text of the same id")]
    want = brute.op4(docs, items)
    d = spark.createDataFrame([(i, t, 7, "x") for i, t in docs], DOCS)
    b = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontamination.contamination(d, b).collect()
    texts = {r["h"]: r["text"] for r in d.select("text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()
             if r["text"]}
    assert len(got) == len(docs)
    for r in got:
        n, hit, found = want.get((r["doc_id"], texts.get(r["text_hash"]))) or brute.op4([(0, "")], items)[0, ""]
        assert (r["n_words"], r["n_hit"], r["items"]) == (n, hit, found), r


def test_decontamination_random_short_alphabet(spark):
    rng = random.Random(4)
    items = [(i, " ".join(rng.choice("abcd") for _ in range(rng.randrange(0, 16)))) for i in range(12)]
    docs = [(i, " ".join(rng.choice("abcd") for _ in range(rng.randrange(0, 60)))) for i in range(40)]
    want = brute.op4(docs, items)
    got = decontamination.contamination(spark.createDataFrame(docs, "doc_id bigint, text string"),
                                        spark.createDataFrame(items, "item_id bigint, text string"))
    for r in got.collect():
        assert (r["n_words"], r["n_hit"], r["items"]) == want[docs[r["doc_id"]]]


def test_decontamination_empty_tables(spark):
    d = spark.createDataFrame([(1, "some words")], "doc_id bigint, text string")
    b = spark.createDataFrame([(1, "some words")], "item_id bigint, text string")
    assert decontamination.report(d.limit(0), b).count() == 0
    row = decontamination.report(d, b.limit(0)).first()
    assert (row["n_words"], row["n_hit"], row["items_sha256"]) == (2, 0, brute.sha([]))


# -- SimHash

def test_simhash_on_the_tables(spark, sf, documents):
    docs = rows_of(documents, "doc_id", "text")
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op5_simhash"](spark, sf).collect()}
    want = {d: (f, c) for d, f, c in brute.op5(docs)}
    assert got == want and any(d != c for d, (_, c) in want.items())


def test_simhash_edges(spark):
    docs = [(i + 5, t) for i, t in enumerate(ODD)] + [(3, None), (None, "one"), (None, "alone without an id here"), (5, None)]
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], DOCS)
    got = sorted(map(str, rows_of(simhash.near_duplicates(d), "doc_id", "fingerprint", "component_id")))
    assert got == sorted(map(str, brute.op5(docs)))
    assert simhash.near_duplicates(d.limit(0)).count() == 0


@pytest.mark.parametrize("limit", [20_000, 40])
@pytest.mark.parametrize("max_bits", [1, 4])
def test_simhash_links_of_dense_and_sparse_fingerprints(spark, monkeypatch, limit, max_bits):
    monkeypatch.setattr(simhash, "BUCKET_LIMIT", limit)
    rng = random.Random(max_bits)
    prints = [rng.getrandbits(64) for _ in range(150)]
    for centre, n, spread in ((0, 200, 6), (prints[0], 120, 3), (prints[1], 60, 8)):
        for _ in range(n):
            f = centre
            for _ in range(rng.randrange(spread + 1)):
                f ^= 1 << rng.randrange(64)
            prints.append(f)
    docs = [(i, "") for i in range(len(prints))]
    want = {(f, c) for _, f, c in brute.op5(docs, max_bits, prints)}
    distinct = sorted(set(prints))
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in distinct], "fp bigint")
    roots = {r["fp"]: r["root"] for r in simhash.components(simhash.links(df, max_bits)).collect()}
    groups = {}
    for f in distinct:
        signed = int(np.uint64(f).view(np.int64))
        groups.setdefault(roots.get(signed, signed), []).append(f)
    first = {f: min(i for i, g in enumerate(prints) if g == f) for f in distinct}
    got = {(f"{f:016x}", min(first[m] for m in members)) for members in groups.values() for f in members}
    assert got == want


def test_simhash_thresholds_cover_every_link():
    rng = np.random.default_rng(1)
    fp = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    bits = np.unpackbits(fp.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(float)
    joint = bits.T @ bits
    for n in (500, 10**6, 10**10):
        parts, chosen = simhash.plan(n, joint * n / 500)
        assert sorted(b for p in parts for b in p) == list(range(64))
        assert sum(t + 1 for t in chosen) == simhash.MAX_BITS + 1


# -- lines

def ordered(docs):
    import functools

    def before(a, b):
        return (a[0] is not None, a[0] or 0, a[2]) < (b[0] is not None, b[0] or 0, b[2])

    return [(i, t) for i, t, _ in sorted(docs, key=functools.cmp_to_key(lambda a, b: -1 if before(a, b) else 1))]


def check_lines(spark, docs, run_words):
    d = spark.createDataFrame([(i, t, 7, "x") for i, t in docs], DOCS)
    hashed = [tuple(r) for r in d.select("doc_id", "text", F.xxhash64("text")).collect()]
    want = brute.op8(ordered(hashed), run_words)
    got = line_dedup.dedup_lines(d, run_words, counts=("before", "gone"))
    assert got.columns == ["doc_id", "text", "n_words", "items", "before", "gone"]
    expected = []
    for i, t in docs:
        gone = want.get((i, t), set())
        text = None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone)
        expected.append((i, text, 7, "x", 0 if t is None else t.count("\n") + 1, len(gone)))
    assert sorted(map(str, [tuple(r) for r in got.collect()])) == sorted(map(str, expected))
    return sum(len(g) for g in want.values())


def test_lines_on_the_tables(spark, documents):
    assert check_lines(spark, rows_of(documents, "doc_id", "text"), 50) > 0


def test_lines_random(spark):
    rng = random.Random(8)
    vocabulary = [" ".join(rng.choice("abcdef") for _ in range(rng.randrange(0, 6))) for _ in range(9)]
    docs = [(rng.randrange(30), "\n".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 14)))) for _ in range(60)]
    assert check_lines(spark, docs, 7) > 0


def test_lines_edges(spark):
    passage = "\n".join(f"passage line {i} " + "w " * 20 for i in range(4))
    docs = [(i, t) for i, t in enumerate(ODD)] + [
        (30, "head\n" + passage + "\ntail"), (31, "other\n" + passage), (31, "other\n" + passage),
        (None, passage), (32, ("same line of five words\n" * 40).strip()), (33, "  " + passage.replace("\n", "  \n"))]
    assert check_lines(spark, docs, 50) > 0
    d = spark.createDataFrame([(1, "x", 1, "y")], DOCS)
    assert line_dedup.dedup_lines(d.limit(0)).count() == 0
