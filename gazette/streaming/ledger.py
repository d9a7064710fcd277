"""The ledger of committed runs.

A run or micro-batch writes several tables: published files, posts, routes, metrics, the
seen state. Each attempt writes its rows under a name of its own, so nothing is ever
overwritten, and one ledger row, written last as one file, makes all of them visible at
once. A crash in between leaves rows that no reader sees; the retry is a new attempt.
Names begin with the run's number, zero-padded, so their text order is the order of runs.

One writer at a time per ledger: two at once keep apart (names have a random part), but the
number they share does not say which came last.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from gazette.sources.config_dim import MAX_BROADCAST_ROWS

SCHEMA = "run string, run_no long, run_ts timestamp_ntz, stream string, epoch long, committed_at timestamp_ntz"


@dataclass(frozen=True)
class Run:
    """One attempt at run number `no`; of a stream, also its name and epoch."""
    name: str
    no: int
    run_ts: _dt.datetime
    stream: str | None = None
    epoch: int | None = None


def ledger_path(out_path: str) -> str:
    return out_path.rstrip("/") + "-runs"


def side_path(out_path: str, what: str) -> str:
    """Where a run's other tables are: next to the published files."""
    return f"{out_path.rstrip('/')}-{what}"


def committed(spark: SparkSession, out_path: str) -> DataFrame:
    """One row for each committed run; no rows before the first one."""
    try:
        return spark.read.schema(SCHEMA).parquet(ledger_path(out_path))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], SCHEMA)
        raise


def begin(spark: SparkSession, out_path: str, run_ts: _dt.datetime, stream: str | None = None, epoch: int | None = None) -> Run | None:
    """The next run, or None if this epoch of the stream is committed already."""
    runs = committed(spark, out_path)
    if stream is not None and not runs.filter((F.col("stream") == stream) & (F.col("epoch") == int(epoch))).isEmpty():
        return None
    no = (runs.agg(F.max("run_no")).first()[0] or 0) + 1
    return Run(f"{no:012d}-{run_ts:%Y-%m-%dT%H-%M-%S}-{uuid.uuid4().hex[:8]}", no, run_ts, stream, epoch)


def commit(spark: SparkSession, out_path: str, run: Run) -> None:
    """Makes the run's rows visible: one file of one row, moved into place by the committer."""
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    row = (run.name, run.no, run.run_ts, run.stream, None if run.epoch is None else int(run.epoch), now)
    spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(ledger_path(out_path))


def visible(rows: DataFrame, runs: DataFrame, *more: str) -> DataFrame:
    """Rows (with their `run`) of committed runs, plus columns of the ledger asked for. The
    ledger is broadcast while it is small, so partitions of other attempts are pruned."""
    names = runs.select("run", *more)
    if names.count() <= MAX_BROADCAST_ROWS:
        names = F.broadcast(names)
    return rows.join(names, "run")


def read_side(spark: SparkSession, out_path: str, what: str) -> DataFrame:
    """A side table (posts, routes, metrics) as committed, with run_no."""
    return visible(spark.read.parquet(side_path(out_path, what)), committed(spark, out_path), "run_no")
