"""Exact deduplication against plain versions: batches, ties, odd rows, an index that is opened again."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from veritab.llm import common, exact_dedup
from veritab.llm.common import scratch_path
from veritab.llm.exact_dedup import DigestIndex

DOCS = "doc_id bigint, text string, digest string, keep_id int, kept boolean"


def sha(text):
    return hashlib.sha256(re.sub("[\x20\x09-\x0d]+", " ", text or "").encode()).hexdigest()


def plain(docs):
    """Rows (doc_id, keep_id, group_size, kept, sha) of (id, text) rows in one table."""
    groups = defaultdict(list)
    for i, t in docs:
        groups[sha(t)].append(i)
    out = Counter()
    for digest, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        for i, n in Counter(ids).items():
            for k in range(n):
                out[i, keep, len(ids), i == keep and k == 0, digest] += 1
    return out


def frame(spark, docs):
    return spark.createDataFrame([(i, t, "x", 7, True) for i, t in docs], DOCS)


ODD = [(5, None), (3, ""), (9, " "), (8, "\t\r\n \x0b\x0c"), (1, "a  b"), (2, "a\n\tb"), (4, " a b"), (4, " a b"), (4, "a b "),
       (None, "a b"), (None, "only null"), (None, "only null"), (7, "long " * 200_000), (6, "long\n" * 200_000),
       (-5, "Ünï code"), (-4, "Ünï code"), (2, "second text of an id"), (11, " "), (12, "😀\t😀")]


@pytest.mark.parametrize("docs", [ODD, [], [(1, "x")], [(None, "x"), (None, None)], [(i % 7, "same") for i in range(300)]])
def test_odd_rows(spark, docs):
    got = exact_dedup.deduplicate(frame(spark, docs))
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == plain(docs)


def test_hot_groups_by_broadcast_and_by_shuffle(spark, monkeypatch):
    docs = [(i, f"t{i % 5 if i % 3 else 'hot'}") for i in range(400)] + [(1000 + i, f"own {i}") for i in range(100)]
    for hot_rows in (1, 60, 10_000):
        monkeypatch.setattr(common, "HOT_ROWS", hot_rows)
        assert Counter(tuple(r) for r in exact_dedup.deduplicate(frame(spark, docs)).collect()) == plain(docs)


def test_batches_against_a_persistent_index(spark):
    path = scratch_path(spark, "index")
    index = DigestIndex.create(spark, path, 1000)
    first = [(10, "one"), (11, "two"), (12, "one ")]
    second = [(1, "two"), (2, "three"), (3, "three"), (4, None), (4, None)]
    assert {r["doc_id"] for r in exact_dedup.new_documents(frame(spark, first), index).collect()} == {10, 11, 12}
    spark.sql(f"DROP TABLE {index.name}")  # the catalog forgets it, as a new session does; the folder stays
    again = DigestIndex.open(spark, path)
    assert again.buckets == index.buckets and again.table().count() == 3
    fresh = exact_dedup.new_documents(frame(spark, second), again)
    assert fresh.columns == ["doc_id", "text", "digest", "keep_id", "kept"]  # clashing names pass
    assert sorted((r["doc_id"], r["text"]) for r in fresh.collect()) == [(2, "three"), (4, None)]
    # a text that the index knows stays with the row that brought it, though a smaller id comes later
    report = {r["doc_id"]: r for r in again.report(again.add(frame(spark, [(1, "two")]))).collect()}
    assert (report[1]["keep_id"], report[1]["kept"]) == (11, False)


def test_a_repeated_batch_appends_nothing(spark):
    index = DigestIndex.create(spark, scratch_path(spark, "index"), 10)
    docs = frame(spark, [(i, f"t{i // 2}") for i in range(20)])
    once = sorted(index.report(index.add(docs)).collect())
    assert index.table().count() == 10
    assert sorted(index.report(index.add(docs)).collect()) == once and index.table().count() == 10


def test_the_index_is_not_moved(spark):
    """A sort-merge anti-join whose index side has no exchange; one file a bucket and batch."""
    index = DigestIndex.create(spark, scratch_path(spark, "index"), 10)
    rows = index.add(frame(spark, [(i, f"t{i}") for i in range(50)]))
    firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("keep_id")).repartition(index.buckets, "digest")
    plan = firsts.join(index.table().select("digest").hint("merge"), "digest", "left_anti") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "LeftAnti" in plan and "Bucketed: true" in plan
    # both exchanges are the batch's own: its digests are merged, then dealt to the buckets
    assert plan.count("Exchange hashpartitioning") == 2


def test_digests_are_merged_before_they_meet_a_small_index(spark, monkeypatch):
    """In a session with Spark's own rules too; the setting is as it was afterwards."""
    index = DigestIndex.create(spark, scratch_path(spark, "index"), 10)
    rows = index.add(frame(spark, [(i, f"t{i % 7}") for i in range(50)]))
    setting = exact_dedup.EXCLUDED_RULES
    ours, plans, found = spark.conf.get(setting), [], DigestIndex.new_digests

    def watched(self, rows):
        new = found(self, rows)
        plans.append(new._jdf.queryExecution().executedPlan().toString())
        return new

    monkeypatch.setattr(DigestIndex, "new_digests", watched)
    try:
        for before in (None, "org.apache.spark.sql.catalyst.optimizer.LimitPushDown"):
            spark.conf.set(setting, before) if before else spark.conf.unset(setting)
            index.add(rows.select("doc_id", F.hex("digest").alias("text")))
            assert spark.conf.get(setting, None) == before
    finally:
        spark.conf.set(setting, ours)
    assert len(plans) == 2
    for plan in plans:
        assert "LeftAnti" in plan and plan.index("SortMergeJoin") < plan.index("HashAggregate")
