"""Queries over small tables with odd values give the rows of their SQL."""

import duckdb

from tessera.plans import catalogue


def test_spread_over_a_least_value_of_zero(spark, tmp_path):
    rows = [("a", 0.0), ("a", 3.0), ("b", 0.0), ("c", -2.0), ("c", 0.0), ("d", 0.5), ("d", 2.0), ("e", None), (None, 1.0), ("f", 0.0), ("f", float("nan"))]
    spark.createDataFrame(rows, "event_type string, value double").write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    order = lambda rs: sorted(map(repr, rs))
    got = order(tuple(r) for r in catalogue.QUERIES["benchmark_stats"](spark, str(tmp_path)).collect())
    assert got == order(con.execute(catalogue.ORACLES["benchmark_stats"]).fetchall())
    assert "('a', 1.5, 0.0, 3.0, inf, False)" in got and "('b', 0.0, 0.0, 0.0, nan, False)" in got


def test_duplicates_of_no_text_and_of_repeated_names(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate([None, "a", None, "b", None, "a", None, None, None, "c"])] + [(1, "a"), (9, "a")]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    df = catalogue.QUERIES["qc_duplicate_digest"](spark, str(tmp_path))
    got = {r.digest: (r.n, r.examples) for r in df.collect()}
    assert got == {d: (n, e) for d, n, e in con.execute(catalogue.ORACLES["qc_duplicate_digest"]).fetchall()}
    assert got[None] == (6, [0, 2, 4, 6, 7]) and len(got) == 2
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation") <= 2  # before, five reads and four joins
