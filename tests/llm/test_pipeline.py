"""The pipeline's stages, each against a plain version on what the stage before kept."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from veritab.llm import compression_quality
from veritab.llm.common import written
from veritab.llm.queries import vocabulary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], sf), f"test-{name}"))
    return out


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_repeats", "near_duplicates", "benchmark_leaks", "sequences"]
    assert all(s.columns == COLUMNS for s in stages[:-1])
    assert corpus_pipeline.ORACLE_SQL is None


def test_quality_stage(spark, sf, stages):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scored = {r["doc_id"]: r["predicted"] for r in compression_quality.classify(stages[0], labels).collect()}
    assert sorted(d for d, p in scored.items() if p) == sorted(d for d, _ in pairs(stages[1]))
    assert stages[1].count() < stages[0].count()


def test_line_stage(stages):
    before = sorted(pairs(stages[1]))
    gone = brute.op8(before)
    want = {d: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[d, t]) for d, t in before}
    assert dict(pairs(stages[2])) == want
    assert stages[2].where(F.char_length("text") != F.col("n_chars")).isEmpty()


def test_near_duplicate_stage(stages):
    kept = brute.op5(sorted(pairs(stages[2])))
    assert sorted(pairs(stages[3])) == sorted((d, t) for d, t in pairs(stages[2]) if (d, d) in {(x, c) for x, _, c in kept})


def test_leak_stage(spark, sf, stages):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    found = brute.op4(pairs(stages[3]), items)
    assert sorted(pairs(stages[4])) == sorted(row for row, (_, hit, _) in found.items() if not hit)


def test_sequence_stage_and_run(spark, sf, stages):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary())
    want = {}
    for d, t in pairs(stages[4]):
        ids = tokenizer.encode(t, add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), 4096):
            want[d, k // 4096] = (len(ids[k:k + 4096]), brute.crc(ids[k:k + 4096]))
    for df in (stages[5], corpus_pipeline.run(spark, sf)):
        assert {(r["doc_id"], r["piece"]): (r["length"], r["ids_crc32"]) for r in df.collect()} == want


def test_stages_take_odd_rows(spark, sf):
    rows = [(None, None, None, None, None), (None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0),
            (2, "word " * 5000, "en", "s", 1), (2, "word " * 5000, "en", "s", 1), (3, "plain words of one text", None, "s", 3)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for name, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, sf), f"odd-{name}")
        assert docs.columns[:2] == ["doc_id", "piece"]
