"""Runs as a whole: the ledger, crashes between tables, many micro-batches, repeated runs,
and reading from a configuration."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gazette import config as C
from gazette.operators import publish as PB
from gazette.sources.documents import articles_from_documents
from gazette.streaming import ledger as L
from gazette.streaming import runs as RN
from tests.conftest import SF001

TS = dt.datetime(2024, 6, 4, 9)


def batch_rows(articles):
    """One file of the same path for each batch, with what the batch held."""
    return articles.groupBy("niche", "run_date").agg(F.concat_ws(",", F.array_sort(F.collect_list(F.col("item_pos").cast("string")))).alias("body")).select(
        "niche", "run_date", F.lit("page").alias("kind"), F.lit("output/page.md").alias("path"), "body")


def articles(spark):
    return articles_from_documents(spark.read.parquet(f"{SF001}/documents.parquet"), niche="World")


def test_twelve_batches_are_in_numeric_order(spark, tmp_path):
    arts, out, seen = articles(spark), str(tmp_path / "out"), str(tmp_path / "seen")
    run = RN.make_batch_fn(seen, out, TS, batch_rows)
    for k in range(12):
        run(arts.filter(F.col("item_pos") == k), k)
    now = PB.current_files(spark.read.parquet(out), L.committed(spark, out)).collect()
    assert [r["body"] for r in now] == ["11"]
    runs = L.committed(spark, out).orderBy("run").collect()
    assert [r["run_no"] for r in runs] == list(range(1, 13)) and [r["epoch"] for r in runs] == list(range(12))


@pytest.mark.parametrize("fails", ["write_published", "write_seen", "commit"])
def test_a_crash_leaves_neither_pages_nor_seen_state(spark, tmp_path, monkeypatch, fails):
    arts, out, seen = articles(spark), str(tmp_path / "out"), str(tmp_path / "seen")
    run = RN.make_batch_fn(seen, out, TS, batch_rows)
    run(arts.filter("item_pos < 3"), 0)
    where = L if fails == "commit" else RN
    real = getattr(where, fails)

    def crash(*args):
        if fails != "commit":
            real(*args)                       # the table is written, and then the executor or driver is lost
        raise OSError("lost")
    monkeypatch.setattr(where, fails, crash)
    with pytest.raises(OSError):
        run(arts.filter("item_pos >= 3 AND item_pos < 6"), 1)
    monkeypatch.setattr(where, fails, real)

    def state():
        runs = L.committed(spark, out)
        files = PB.current_files(spark.read.parquet(out), runs).collect()
        return [r["body"] for r in files], RN.seen_table(spark, seen, TS, runs=runs).count()
    assert state() == (["0,1,2"], 3)
    run(arts.filter("item_pos >= 3 AND item_pos < 6"), 1)          # the retry takes all of them
    assert state() == (["3,4,5"], 6)
    run(arts.filter("item_pos >= 3 AND item_pos < 6"), 1)          # a repeat of a committed epoch
    assert state() == (["3,4,5"], 6) and L.committed(spark, out).count() == 2


def test_a_stream_keeps_its_epochs_over_restarts(spark, tmp_path):
    arts = articles(spark).drop("date")
    land, out, seen, ck = (str(tmp_path / p) for p in ("land", "out", "seen", "ck"))
    for k, ts in enumerate((TS, TS + dt.timedelta(days=1))):
        arts.filter(F.col("item_pos") % 2 == k).write.mode("append").parquet(land)
        RN.start_incremental(spark.readStream.schema(arts.schema).parquet(land), seen, out, ck, ts, batch_rows).awaitTermination()
    runs = L.committed(spark, out).orderBy("run_no").collect()
    assert [r["epoch"] for r in runs] == [0, 1] and len({r["stream"] for r in runs}) == 1
    assert len(runs[0]["stream"]) == 36                              # the query's own id, not a time
    assert RN.seen_table(spark, seen).count() == arts.select("article_id").distinct().count()


def test_same_run_time_twice_adds_what_is_new(spark, tmp_path):
    from gazette.digest import run_digest
    arts, out, seen = articles(spark), str(tmp_path / "out"), str(tmp_path / "seen")
    run_digest(arts.filter("item_pos < 30"), out, seen, TS, run_cap=5)
    first = {r["path"] for r in PB.current_files(spark.read.parquet(out)).collect()}
    m = run_digest(arts.filter("item_pos < 60"), out, seen, TS, run_cap=5, channels={"social": True, "site": True}).collect()
    assert sum(r["articles_scraped"] for r in m) == 30
    files = PB.current_files(spark.read.parquet(out), L.committed(spark, out))
    assert first <= {r["path"] for r in files.collect()}
    assert RN.seen_table(spark, seen).count() == 60
    assert L.read_side(spark, out, "metrics").select("run_no").distinct().count() == 2
    assert L.read_side(spark, out, "posts").count() >= 4 and L.read_side(spark, out, "routes").filter("dest_path LIKE '%latest-World.md'").count() == 1


def test_unconfigured_kinds_and_sources_are_not_read(spark, tmp_path):
    import dataclasses
    from gazette.plans.run_plans import CONFIG, land_tables
    from gazette.sources.landed import articles_from_config, read_configured
    landed = str(tmp_path / "landed")
    land_tables(spark, SF001, landed)
    cfg = C.run_config_from_dict(CONFIG, sources="rss")
    items = read_configured(spark, landed, cfg)
    plan = items._jdf.queryExecution().toString()
    assert "dynamicpruning" in plan and "kind" in plan[plan.index("PartitionFilters"):][:300]
    files = {f.rsplit("/", 1)[0] for f in items.select(F.input_file_name().alias("f")).distinct().toPandas()["f"]}
    assert len(files) == 3 and all("kind=rss" in f for f in files)
    arts = articles_from_config(spark, cfg, landed)
    caps = {r["source_name"]: r["n"] for r in arts.groupBy("source_name").agg(F.count("*").alias("n")).collect()}
    assert set(caps) == {"src0", "src3", "src7"} and caps["src0"] == 3 and arts.select("niche").distinct().collect()[0][0] == "World"
    none = dataclasses.replace(cfg, sources=())
    assert articles_from_config(spark, none, landed).collect() == []
