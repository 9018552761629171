"""The two logs of a run become visible together (L1, L2), and their ids (L3).

A run writes its status rows and its error rows to new parts of the two log
folders (``run_id=<id>/commit=<commit>``) and then one row to the manifest beside
the status log (``<status log>__commits``): one file, visible by one rename.  A part
counts only if the manifest names it, so a run that fails between the writes
leaves neither log changed for those who read with :func:`read_log`.  A run that is repeated
under its id commits again; the last commit counts, and the parts it replaces are
emptied.

Status ids are made of the run's clock and a hash of the run, so no run has to look for the
highest id of the others: seconds since 2020 (31 bits), run hash (14 bits), row
(18 bits: 26,000 tables of ten ids).  Ids of a later second are larger, whatever
runs at the same time; two runs of one second differ by their hash, and a run whose
id range another one has already committed takes the next hash.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMMITS = "run_id string, commit string, number bigint, id_base bigint, status_rows bigint, error_rows bigint"
_EPOCH = _dt.datetime(2020, 1, 1)
_HASH_BITS, _ROW_BITS = 14, 18


class LogConstraintError(ValueError):
    """The log rows of a run break a declared constraint; nothing was published."""


def id_base(run_id: str, run_ts: str | _dt.datetime | None = None, turn: int = 0) -> int:
    """First status id of a run; ``turn`` chooses another hash."""
    if run_ts is None:
        at = _dt.datetime.now(_dt.UTC).replace(tzinfo=None)
    else:
        at = _dt.datetime.fromisoformat(run_ts) if isinstance(run_ts, str) else run_ts
    seconds = max(0, int((at.replace(tzinfo=None) - _EPOCH).total_seconds())) & ((1 << 31) - 1)
    digest = int.from_bytes(hashlib.sha256(f"{run_id}/{turn}".encode()).digest()[:8], "big")
    return (seconds << (_HASH_BITS + _ROW_BITS)) | ((digest & ((1 << _HASH_BITS) - 1)) << _ROW_BITS)


def _manifest_path(status_log: str) -> str:
    return f"{status_log.rstrip('/')}__commits"


def commits(spark: SparkSession, status_log: str) -> DataFrame:
    """The manifest: one row per commit of a run."""
    try:
        found = spark.read.schema(COMMITS).parquet(_manifest_path(status_log))
        found.inputFiles()
        return found
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COMMITS)


def _current(manifest: DataFrame) -> DataFrame:
    """The commit of each run that counts."""
    return manifest.groupBy("run_id").agg(F.max_by("commit", "number").alias("commit"))


def read_log(spark: SparkSession, path: str, status_log: str) -> DataFrame:
    """The committed rows of a log; the manifest (a row per run) is beside ``status_log``."""
    parts = [f"{path.rstrip('/')}/run_id={r['run_id']}/commit={r['commit']}"
             for r in _current(commits(spark, status_log)).collect()]
    if not parts:
        raise FileNotFoundError(f"no committed run in {path}")
    return spark.read.option("basePath", path).parquet(*parts)


def publish(spark: SparkSession, run_id: str, make_logs, status_log: str, error_log: str,
            run_ts=None, check=None) -> None:
    """Write both logs of a run and commit them.

    ``make_logs(id_base)`` gives (status rows, error rows); ``check(status rows,
    error rows)`` may refuse the written parts by raising an error.
    """
    manifest = commits(spark, status_log)
    taken = {r["id_base"]: r["run_id"] for r in manifest.select("id_base", "run_id").collect()}  # a row per run
    before = manifest.where(F.col("run_id") == run_id).orderBy("number").collect()
    turn = 0
    while taken.get(base := id_base(run_id, run_ts, turn), run_id) != run_id:
        turn += 1
    commit = uuid.uuid4().hex
    written = []
    for frame, path in zip(make_logs(base), (status_log, error_log)):
        part = f"{path.rstrip('/')}/run_id={run_id}/commit={commit}"
        frame.coalesce(1).write.mode("overwrite").parquet(part)
        written.append(spark.read.schema(frame.schema).parquet(part))
    if check is not None:
        check(*written)
    row = (run_id, commit, len(before), base, *(w.count() for w in written))
    spark.createDataFrame([row], COMMITS).coalesce(1).write.mode("append").parquet(_manifest_path(status_log))
    for old in before:  # what this commit replaces; harmless if it is cut off
        for frame, path in zip(written, (status_log, error_log)):
            part = f"{path.rstrip('/')}/run_id={run_id}/commit={old['commit']}"
            frame.limit(0).coalesce(1).write.mode("overwrite").parquet(part)
