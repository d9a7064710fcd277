import datetime as dt
import random

import pytest

from gazette.operators.dedup import ttl_dedup
from tests.conftest import SF001


def brute(rows, ttl_days=7):
    """Reference fold: per key in (ts, id) order, accept when ts >= last accepted + ttl."""
    out, last = [], {}
    for eid, key, ts in sorted(rows, key=lambda r: (str(r[1]), r[2], r[0])):
        if key not in last or ts >= last[key] + dt.timedelta(days=ttl_days):
            last[key] = ts
            out.append(eid)
    return sorted(out)


def test_fixture_offsets(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(i, "k", base + dt.timedelta(days=d)) for i, d in enumerate([0, 3, 7, 8, 14, 20])]
    df = spark.createDataFrame(rows, "event_id long, key string, ts timestamp")
    kept = sorted(r.event_id for r in ttl_dedup(df, ["key"], checkpoint=False).collect())
    assert kept == [0, 2, 4]                                 # days 0, 7, 14


def test_matches_brute_force_random(spark):
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(600):
        key = rnd.choice(["hot"] * 6 + ["a", "b", None])     # one key holds most rows; a null key
        rows.append((i, key, base + dt.timedelta(seconds=rnd.randrange(0, 90 * 86400))))
    rows.append((600, "hot", rows[3][2] if rows[3][1] == "hot" else base))  # a tie on ts
    df = spark.createDataFrame(rows, "event_id long, key string, ts timestamp")
    got = sorted(r.event_id for r in ttl_dedup(df, ["key"], slice_seconds=86400, checkpoint=False).collect())
    assert got == brute(rows)


def stream_of(spark, schema, land):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(land)


def test_stream_equals_batch(spark, tmp_path):
    from gazette.streaming.ttl import accepted_rows, start_ttl_dedup
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    stream = spark.readStream.schema(ev.schema).option("pathGlobFilter", "events.parquet").parquet(SF001)
    start_ttl_dedup(stream, ["user_id", "event_type"], str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(600)
    s = {tuple(r) for r in accepted_rows(spark, str(tmp_path / "out")).select("event_id", "user_id", "event_type", "ts").collect()}
    b = {tuple(r) for r in ttl_dedup(ev, ["user_id", "event_type"]).select("event_id", "user_id", "event_type", "ts").collect()}
    assert s == b and len(s) > 0


def fold_batches(batches, ttl_days=7):
    """Every micro-batch in (ts, id) order, one after the other."""
    out, last = [], {}
    for rows in batches:
        for eid, key, ts in sorted(rows, key=lambda r: (r[2], r[0])):
            if key not in last or ts >= last[key] + dt.timedelta(days=ttl_days):
                last[key] = ts
                out.append(eid)
    return sorted(out)


def test_stream_over_triggers_a_crash_and_a_restart(spark, tmp_path, monkeypatch):
    """Four micro-batches with a hot key, a null key and late rows; the third is lost after
    its rows are written and comes again with the restarted query."""
    from gazette.streaming import ledger as L
    from gazette.streaming.ttl import accepted_rows, start_ttl_dedup
    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 1)
    batches = [[(100 * b + i, rnd.choice(["hot"] * 6 + ["a", "b", None]), base + dt.timedelta(seconds=rnd.randrange(max(0, 20 * b - 15) * 86400, (20 * b + 20) * 86400)))
                for i in range(100)] for b in range(4)]
    schema = "event_id long, key string, ts timestamp"
    land, out, ck = (str(tmp_path / p) for p in ("land", "out", "ck"))

    def land_batch(b):
        spark.createDataFrame(batches[b], schema).coalesce(1).write.mode("append").parquet(land)
    land_batch(0)
    land_batch(1)
    source = spark.read.parquet(land).schema
    start_ttl_dedup(stream_of(spark, source, land), ["key"], out, ck).awaitTermination()
    land_batch(2)
    real = L.commit

    def lost(*args):
        raise OSError("lost")
    monkeypatch.setattr(L, "commit", lost)
    q = start_ttl_dedup(stream_of(spark, source, land), ["key"], out, ck)
    with pytest.raises(Exception):
        q.awaitTermination()
    monkeypatch.setattr(L, "commit", real)
    assert sorted(r.event_id for r in accepted_rows(spark, out).collect()) == fold_batches(batches[:2])
    land_batch(3)
    start_ttl_dedup(stream_of(spark, source, land), ["key"], out, ck).awaitTermination()
    assert sorted(r.event_id for r in accepted_rows(spark, out).collect()) == fold_batches(batches)
    assert L.committed(spark, out).count() == 4


def test_emerging_stream_equals_batch_for_closed_days(spark, tmp_path):
    from pyspark.sql import functions as F
    from gazette.streaming.topics import daily_topic_counts, emerging, emerging_rows, start_emerging
    ev = spark.read.parquet(f"{SF001}/events.parquet").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    land, out, ck = (str(tmp_path / p) for p in ("land", "out", "ck"))
    for part in (F.dayofmonth("ts") < 12, F.dayofmonth("ts") >= 12):       # days close over two runs
        ev.filter(part).coalesce(1).write.mode("append").parquet(land)
        start_emerging(stream_of(spark, ev.schema, land), "ts", "event_type", out, ck).awaitTermination()
    cols = ["day", "topic", "n", "prev_n", "growth"]
    want = {tuple(r) for r in emerging(daily_topic_counts(ev, "ts", "event_type")).select(cols).collect()}
    got = [tuple(r) for r in emerging_rows(spark, out).select(cols).collect()]
    last = max(r[0] for r in got)
    assert len(got) == len(set(got)) and set(got) == {r for r in want if r[0] <= last} and last >= "2024-01-27"
