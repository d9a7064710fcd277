import duckdb

import __spark_entry__ as E
from tests.conftest import SF001

FAST = ["articles_from_documents", "dedup_first", "ttl_dedup", "page_title", "page_links_resolved",
        "feed_items", "parse_web_dates", "trends_whole_edition", "edition", "newsletter_markdown"]


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and "trend" in df.columns


def test_every_query_has_an_oracle():
    from gazette.plans import registry
    assert set(registry.queries()) == set(registry.oracles())


def test_oracles_match_at_smallest_scale(spark):
    con = duckdb.connect()
    for t in ("documents", "pages", "events", "labels", "conversations", "orders", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    qs, sql = E.queries(), E.oracle_sql()
    for name in FAST:
        s = qs[name](spark, SF001).toPandas()
        d = con.execute(sql[name]).fetchdf()
        assert sorted(s.columns) == sorted(d.columns), name
        key = sorted(s.columns)
        norm = lambda df: sorted(tuple(str(v) for v in r) for r in df[key].astype(object).where(df[key].notna(), None).itertuples(index=False))
        assert norm(s) == norm(d), name
