import datetime as dt

from mapledger.operators import history
from mapledger.schemas import TABLES

LOG = "audit_name STRING, map_name STRING, file_name STRING, sql_server STRING, sql_database STRING, table_name STRING, load_start TIMESTAMP_NTZ"


def test_summary_boundaries(spark, rows):
    first, last = dt.datetime(2022, 1, 1), dt.datetime(2021, 12, 31, 23, 59, 59)
    log = spark.createDataFrame(
        [("A", "m", "a", "s2", "d", "t", first), ("A", "m", "b", "s1", "d", "t", first), ("A", "m", "z", "z", "z", "z", last),
         ("A", "n", "z", "z", "z", "z", None), ("A", None, "c", "s", "d", "t", first), ("A", None, "d", None, "d", "t", first)],
        LOG,
    )
    expected = [("A", None, "d", "s", "d", "t", first, 3), ("A", "m", "b", "s2", "d", "t", first, 3)]
    assert rows(history.load_summary(log, run_id=3)) == sorted(expected, key=repr)
    # the audit may also be told
    assert rows(history.load_summary(log.drop("audit_name"), audit="A", run_id=3)) == sorted(expected, key=repr)


def test_year_filter_reaches_the_files(spark, tmp_path):
    path = str(tmp_path / "log")
    spark.createDataFrame([("A", "m", "f", "s", "d", "t", dt.datetime(2022, 1, 1))], LOG).write.parquet(path)
    plan = history.load_summary(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(load_start,2022-01-01T00:00)" in plan


def events(spark, *found):
    return spark.createDataFrame(
        [("A", "1", f"folder{run}", "m", "Map", "e", "a", parameter, value, run, 0, pos) for parameter, value, run, pos in found],
        TABLES["map_events"],
    )


def test_events_keep_each_value_once(spark):
    found = events(spark, ("p", "old", 1, 0), ("p", "new", 2, 0), ("p", "old", 2, 1), (None, None, 1, 2), (None, None, 2, 2))
    kept = history.dedupe_events(found)
    values = sorted(((r.parameter_name, r.parameter_value, r.run_id) for r in kept.collect()), key=repr)
    assert values == sorted([("p", "old", 2), ("p", "new", 2), (None, None, 2)], key=repr)
    assert history.dedupe_events(kept).count() == kept.count()


def test_one_audit_leaves_the_others(spark):
    found = events(spark, ("p", "v", 1, 0), ("p", "v", 2, 0))
    both = found.unionByName(found.selectExpr("'B' AS audit_name", *[c for c in found.columns if c != "audit_name"]))
    kept = history.dedupe_events(both, audit="A").groupBy("audit_name").count()
    assert sorted(map(tuple, kept.collect())) == [("A", 1), ("B", 2)]


def test_headers_keep_the_latest_state(spark):
    row = {name.split()[0]: None for name in TABLES["map_header"].split(", ")}
    table = [{**row, "audit_name": "A", "map_id": "1", "map_name": "m", "header": h, "run_id": r, "doc_ord": o} for h, r, o in [("a", 1, 9), ("b", 2, 1), ("c", 2, 2)]]
    headers = spark.createDataFrame(table, TABLES["map_header"])
    assert [r.header for r in history.dedupe_headers(headers).collect()] == ["c"]


def test_hot_key_shrinks_before_the_exchange(spark):
    found = events(spark, ("p", "v", 1, 0))
    plan = history.dedupe_events(found)._jdf.queryExecution().executedPlan().toString()
    partial, exchange = plan.index("Partial"), plan.index("Exchange")
    assert "WindowGroupLimit" in plan and exchange < partial  # the plan prints from the top
