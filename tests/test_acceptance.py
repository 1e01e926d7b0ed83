import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from mapledger.functions.text import base_name, like_contains, overlong_values, same_text
from mapledger.operators import tablediff, tablepairs
from mapledger.operators.matching import contains_pairs
from mapledger.plans import acceptance
from mapledger.schemas import TABLES


def like(value, part):
    """Plain LIKE '%part%' by position sets."""
    pattern = "%" + part + "%"
    reach = {0}
    for ch in pattern:
        if ch == "%":
            reach = set(range(min(reach), len(value) + 1)) if reach else set()
        else:
            reach = {i + 1 for i in reach if i < len(value) and (ch == "_" or value[i] == ch)}
    return len(value) in reach


TEXTS = ["order_1.tf.xml", "order_12.tf.xml", "order-1~x", "Y:\\maps\\a_b\\c.map.xml", "", "a", "aaaaaaa", "100% x", "a\nb", "été", "[x]"]
PARTS = ["order_1", "1", "_", "%", "", "~", "\\maps\\", "a_b", "aaa", "0% x", "order_1.tf.xml", "a\nb", "t%x", "é_é", "[x]", "no", "______________"]


@pytest.mark.parametrize("match", ["like", "ilike", "literal"])
def test_containment_join_equals_brute_force(spark, match):
    rng = random.Random(3)
    values = TEXTS + ["".join(rng.choices("aAb_%~.x", k=rng.randint(0, 12))) for _ in range(60)]
    parts = PARTS + ["".join(rng.choices("aAb_%~.x", k=rng.randint(0, 8))) for _ in range(60)]
    left = spark.createDataFrame([(v,) for v in values + [None, "a"]], "v STRING")
    right = spark.createDataFrame([(p,) for p in parts + [None, "a"]], "p STRING")
    holds = {
        "like": like,
        "ilike": lambda value, part: like(value.lower(), part.lower()),
        "literal": lambda value, part: part in value,
    }[match]
    expected = sorted((v, p) for v in set(values) for p in set(parts) if holds(v, p))
    assert sorted(map(tuple, contains_pairs(left, "v", right, "p", match).collect())) == expected


@pytest.mark.parametrize("part", PARTS)
def test_like_with_a_constant(spark, part):
    df = spark.createDataFrame([(t,) for t in TEXTS], "v STRING")
    assert sorted(r.v for r in df.where(like_contains("v", part)).collect()) == sorted(t for t in TEXTS if like(t, part))


def test_equality_ignores_trailing_spaces(spark):
    df = spark.createDataFrame([("5",), ("5 ",), (" 5",), ("55",), (None,)], "v STRING")
    for argument in ("5", "5  "):
        assert [r.v for r in df.where(same_text("v", argument)).collect()] == ["5", "5 "]


def test_base_name_without_backslash(spark):
    df = spark.createDataFrame([("a\\b\\c.x",), ("plain",), ("end\\",), (None,)], "v STRING")
    assert [r[0] for r in df.select(base_name("v")).collect()] == ["c.x", "plain", "", None]


def test_overlong_values_are_listed_not_cut(spark):
    df = spark.createDataFrame([("abc", "x"), ("ab", None)], "a STRING, b STRING")
    assert [tuple(r) for r in overlong_values(df, {"a": 2, "b": 1}).collect()] == [("abc", "x", ["a"])]


@pytest.fixture
def tables(spark):
    package = {name.split()[0]: None for name in TABLES["packages"].split(", ")}
    packages = [
        {**package, "audit_id": "a", "pack_id": p, "audit_name": n, "phase": "5", "legacy_table": f"dbo.T{p}", "new_table": f"dbo.N{p}", "legacy_maps": m}
        for p, n, m in [("1", "client mx", "x.tf.xml;b_x.tf.xml"), ("2", "client mx", "b_x.tf.xml"), ("3", "client us", "b_x.tf.xml"), ("4", "other", "c.tf.xml")]
    ]
    log = "engine STRING, data_group STRING, file_name STRING, map_name STRING, table_name STRING, s_file_name STRING, records_read BIGINT, records_written BIGINT, file_size BIGINT, sql_database STRING"
    return {
        "clients": spark.createDataFrame([("client mx", "5", "t", "l", "n"), ("client mx", "6 ", "t", "l", "n")], TABLES["clients"]),
        "packages": spark.createDataFrame(packages, TABLES["packages"]),
        "map_variables": spark.createDataFrame([("b_x.tf.xml", "v"), ("bax.tf.xml", "w")], "map_name STRING, name STRING"),
        "comparison_flags": spark.createDataFrame([("a", "2", 0, 1, 0, 0), ("a", "1", 1, 0, 0, 0)], TABLES["comparison_flags"]),
        "structure_diffs": spark.createDataFrame([("2", "c"), ("1", "c")], "pack_id STRING, column_name STRING"),
        "data_diffs": spark.createDataFrame([("2", "c"), ("1", "c")], "pack_id STRING, column_name STRING"),
        "load_log": spark.createDataFrame(
            [("legacy", None, "f", "d\\bax.map.xml", "T", None, 1, 1, 1, None), ("new", None, "f", "d\\b_x2.dtsx", "T", None, 1, 1, 1, None), ("new", None, "f", "d\\c.dtsx", "T", None, 1, 1, 1, None)], log
        ),
        "special_events": spark.createDataFrame([("mx", "b_x.tf.xml", 1), ("client mx", "b_x.tf.xml", 2)], "audit_name STRING, map_name STRING, n INT"),
    }


def test_report_of_one_map(spark, tables):
    tables |= {"legacy_data": spark.range(3), "new_data": spark.range(1, 4)}
    report = acceptance.acceptance_report(tables, "mx", "b_x.tf.xml", "5", compare=True)
    counts = {name: df.count() for name, df in report.items()}
    assert counts == {
        "client": 1, "package": 1, "package_overview": 2, "map_variables": 1, "comparison_flags": 1, "structure_diffs": 1,
        "data_diffs": 0, "load_lines_legacy": 1, "load_lines_new": 1, "special_events": 1,
        "compare_structure": 0, "compare_rows": 2, "comparison_summary": 1,
    }
    package = report["package"].first()
    assert (package.pack_id, package.legacy_table, package.match_count) == ("2", "T2", 2)
    assert acceptance.load_lines(tables["load_log"], "legacy", "b_x.tf.xml", match="literal").count() == 0
    none = acceptance.find_package(tables["packages"], "mx", "5", "nothing").first()
    assert (none.pack_id, none.match_count) == ("", 0)


def test_report_of_many_maps_equals_report_of_each(spark, tables):
    asked = [("r1", "mx", "5", "b_x.tf.xml"), ("r2", "client", "5", "x.tf.xml"), ("r3", "", "6", "c.tf.xml"), ("r4", "other", "5 ", "c.tf.xml ")]
    requests = spark.createDataFrame(asked, "request_id STRING, audit_name STRING, phase STRING, map_name STRING")
    many = acceptance.acceptance_report_all(tables, requests)
    for request_id, audit, phase, map_name in asked:
        one = acceptance.acceptance_report(tables, audit, map_name, phase)
        assert set(one) == set(many)
        for name, df in one.items():
            tagged = many[name].where(F.col("request_id") == request_id).select(*df.columns)
            assert sorted(map(tuple, tagged.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr), name


def test_compare_tables(spark, rows):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "z")], "ID INT, t STRING")
    b = spark.createDataFrame([(1, "x"), (2, None), (4, "w")], "id BIGINT, t STRING").withColumn("extra", F.lit(1))
    found = acceptance.compare_tables(a, b)
    assert rows(found["compare_structure"].select("column_key", "problem")) == [("extra", "only in b"), ("id", "type")]
    assert rows(found["compare_rows"]) == [(1, "x", 2, 1), (3, "z", 1, 0), (4, "w", 0, 1)]
    assert tuple(found["comparison_summary"].first()) == (1, 1, 2, 2, 1)
    same = acceptance.compare_tables(a, a)["comparison_summary"].first()
    assert tuple(same) == (0, 0, 0, 0, 0)


def test_row_differences_equal_except_all(spark, rows):
    rng = random.Random(5)
    a, b = (spark.createDataFrame([(rng.randint(0, 3), rng.choice(["x", None])) for _ in range(20)], "i INT, s STRING") for _ in "ab")
    found = tablediff.compare_rows(a, b)
    more_a = found.where("count_a > count_b").selectExpr("i", "s", "explode(sequence(1, int(count_a - count_b)))").select("i", "s")
    more_b = found.where("count_b > count_a").selectExpr("i", "s", "explode(sequence(1, int(count_b - count_a)))").select("i", "s")
    assert rows(more_a) == rows(a.exceptAll(b)) and rows(more_b) == rows(b.exceptAll(a))


def test_compare_columns_of_differing_types(spark, rows):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id INT, t STRING")
    b = spark.createDataFrame([("1", "x"), ("02", "y"), ("no number", "z")], "id STRING, t STRING")
    assert rows(tablediff.compare_rows(a, b)) == [("02", "y", 0, 1), ("2", "y", 1, 0), ("no number", "z", 0, 1)]


def test_compare_structure_with_lengths(spark, rows):
    columns = "table_name STRING, column_name STRING, data_type STRING, ordinal BIGINT, data_length STRING"
    a = spark.createDataFrame([("t", "A", "char", 1, "4"), ("t", "b", "char", 2, None), (None, "x", "char", 1, "1")], columns)
    b = spark.createDataFrame([("t", "a", "char", 1, "8"), ("t", "B", "char", 3, None), (None, "x", "char", 1, "1")], columns)
    found = tablediff.compare_structure(a, b).select("table_name", "column_key", "problem", "length_a", "length_b")
    assert rows(found) == [("t", "a", "length", "4", "8"), (None, "x", "only in a", "1", None), (None, "x", "only in b", None, "1")]
    assert "SinglePartition" not in found._jdf.queryExecution().executedPlan().toString()


def test_load_lines_of_the_own_client(spark, rows):
    log = spark.createDataFrame(
        [("legacy", db, "d", "f", "m.map.xml", "t", "s", 1, 1, 1, db) for db in ("dbA", "dbB")],
        "engine STRING, tracker_db STRING, data_group STRING, file_name STRING, map_name STRING, table_name STRING, s_file_name STRING, "
        "records_read BIGINT, records_written BIGINT, file_size BIGINT, sql_database STRING",
    )
    requests = spark.createDataFrame([(1, "A", "1", "m.tf.xml"), (2, "B", "1", "m.tf.xml")], "request_id INT, audit_name STRING, phase STRING, map_name STRING")
    databases = spark.createDataFrame([(1, "dbA "), (2, "dbB"), (2, "dbC")], "request_id INT, tracker_db STRING")
    found = acceptance.load_lines_for(requests, log, "legacy", databases=databases)
    assert rows(found.select("request_id", "sql_database")) == [(1, "dbA"), (2, "dbB")]
    assert acceptance.load_lines_for(requests, log, "legacy").count() == 4
    assert [r.sql_database for r in acceptance.load_lines(log, "legacy", "m.tf.xml", tracker_db="dbB").collect()] == ["dbB"]


def test_many_pairs_equal_each_one(spark, rows):
    rng = random.Random(8)

    def table(schema, values, n):
        return spark.createDataFrame([tuple(rng.choice(v) for v in values) for _ in range(n)], schema)

    numbers, words, parts = [1, 2, None], ["x", "y", "", None, "null"], [Decimal("1.5"), Decimal("-2"), None]
    pairs = {
        "p": tuple(table("i INT, s STRING, t STRING", [numbers, words, words], 60) for _ in "ab"),
        "q": (table("I BIGINT, f FLOAT", [numbers, [0.0, -0.0, 0.5]], 30), table("f DOUBLE, i SMALLINT", [[0.0, 0.5], numbers], 30)),
        "r": (table("d DECIMAL(5,2)", [parts], 20), table("d DECIMAL(9,4)", [parts], 20)),
        "s": (table("i INT", [numbers], 9), table("i STRING", [["1", "02", None]], 9)),
        "t": (table("i INT", [numbers], 9), None),
        "u": (table("i INT", [numbers], 0), table("i INT", [numbers], 0)),
        "v": (table("i INT, a ARRAY<INT>", [numbers, [[1, None], [], None]], 40),) * 2,
        "w": (table("i INT", [numbers], 9), table("k INT", [numbers], 4)),
    }
    many = tablepairs.compare_pairs(spark, pairs, buckets=4)
    for pair_id, (a, b) in pairs.items():
        one = acceptance.compare_tables(a, b if b is not None else spark.createDataFrame([], a.schema))
        found = many["compare_rows"].where(F.col("pair_id") == pair_id)
        counts = one["compare_rows"].select("count_a", "count_b")
        assert rows(found.select("count_a", "count_b")) == rows(counts), pair_id
        if pair_id == "p":
            cells = found.select(*[F.col("cells")[n] for n in range(3)], "count_a", "count_b")
            assert rows(cells) == rows(one["compare_rows"].withColumn("i", F.col("i").cast("string")))
        if b is not None:
            assert rows(tablepairs.compare_rows_by_bucket(a, b, buckets=4)) == rows(one["compare_rows"])
            summary = many["comparison_summary"].where(F.col("pair_id") == pair_id).drop("pair_id")
            assert rows(summary) == rows(one["comparison_summary"])
    assert rows(many["compare_structure"].where("pair_id = 't'").select("column_key", "problem")) == [("i", "only in a")]
    assert tablepairs.compare_pairs(spark, {})["comparison_summary"].count() == 0


def test_only_unequal_buckets_are_kept(spark):
    a = spark.range(20_000).select("id", (F.col("id") % 7).alias("n"))
    b = a.withColumn("n", F.when(F.col("id") == 77, None).otherwise(F.col("n")))
    tagged = tablediff.tagged_rows(a, b, ["id", "n"])
    assert 2 <= tablepairs.keep_unequal(tagged, ["id", "n"]).count() < 50
    # what is repeated equally often on both sides cancels, and a change of places of NULL does not
    c = spark.createDataFrame([(None, "x"), ("y", "y")], "s STRING, t STRING")
    d = spark.createDataFrame([("x", None), ("y", "y")], "s STRING, t STRING")
    assert tablepairs.compare_rows_by_bucket(c, d).count() == 2
    with pytest.raises(ValueError):
        tablepairs.compare_rows_by_bucket(c, d, buckets=3)


def test_equal_rows_of_unequal_buckets_are_left_out(spark, rows):
    """However many rows share a bucket with a difference."""
    a = spark.range(20_000).select("id", F.when(F.col("id") % 3 > 0, F.concat(F.lit("t"), "id")).alias("t"))
    b = a.where("id <> 5").withColumn("t", F.when(F.col("id") == 77, "u").otherwise(F.col("t"))).unionByName(a.where("id = 9"))
    assert 4 <= tablepairs.keep_unequal(tablediff.tagged_rows(a, b, ["id", "t"]), ["id", "t"], buckets=1).count() < 100
    found = rows(tablediff.compare_rows(a, b))
    assert rows(tablepairs.compare_rows_by_bucket(a, b, buckets=1)) == found and len(found) == 4
    pairs = tablepairs.compare_pairs_rows(spark, {"t": (a, b), "same": (a, a)}, buckets=1)
    assert rows(pairs.selectExpr("cast(cells[0] AS BIGINT)", "cells[1]", "count_a", "count_b")) == found


def test_packages_of_many_requests(spark, rows):
    tables = {"old": spark.range(3), "new": spark.range(4), "same": spark.range(3)}
    asked = [("r1", "p1", "old", "new"), ("r2", "p2", "old", "same"), ("r3", "p1", "old", "new"), ("r4", "", "", ""), ("r5", "p3", "old", "gone")]
    package = spark.createDataFrame(asked, "request_id STRING, pack_id STRING, legacy_table STRING, new_table STRING")
    found = acceptance.compare_packages(package, tables.get)
    assert rows(found["compare_rows"].select("request_id", "cells", "count_b").where("count_b = 1")) == [("r1", ["3"], 1), ("r3", ["3"], 1)]
    flags = found["comparison_summary"].select("request_id", "has_template_difference", "has_data_difference")
    assert rows(flags) == [("r1", 0, 1), ("r2", 0, 0), ("r3", 0, 1), ("r5", 1, 1)]


@pytest.mark.parametrize("query", ["find_package_for", "package_overview_for", "clients_for"])
def test_requests_are_not_broadcast(spark, tables, query):
    requests = spark.createDataFrame([("1", "client mx", "5", "b_x.tf.xml"), ("2", "client _x", "5", "x.tf.xml")], "request_id STRING, audit_name STRING, phase STRING, map_name STRING")
    found = getattr(acceptance, query)(requests, tables["clients" if query == "clients_for" else "packages"])
    assert found.collect()  # the plan of an empty join has no exchange at all
    assert "BroadcastExchange" not in found._jdf.queryExecution().executedPlan().toString()
