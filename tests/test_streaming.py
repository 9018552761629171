"""Technical checks per micro-batch of a CSV file stream."""

from veritab.functions.rules import make_rule
from veritab.streaming import validate_stream


def test_stream_batches(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.csv").write_text("a,b\n1,x\n100,y\n")
    (src / "b.csv").write_text("a,b\n2,zz\n")
    stream = spark.readStream.schema("a string, b string").option("header", True) \
        .option("maxFilesPerTrigger", 1).csv(str(src))
    rules = [make_rule("a", "INT", 2, nullable=False, position=1), make_rule("b", "STRING", 1, position=2)]
    q = validate_stream(stream, "t1", rules, str(tmp_path / "out"), str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    by_col = {}
    for r in rows:
        by_col[r["column_name"]] = by_col.get(r["column_name"], 0) + r["violations"]
    assert by_col == {"a": 1, "b": 1}
    assert sum(r["row_count"] for r in rows if r["column_name"] == "a") == 3
