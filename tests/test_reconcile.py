import random

from pyspark.sql import functions as F

from mapledger.operators import reconcile

LOG = "file_name STRING, map_name STRING, table_name STRING, records_read BIGINT, records_written BIGINT"
PACKAGES = "audit_id STRING, pack_id STRING, audit_name STRING, legacy_table STRING, new_table STRING"
FLAGS = "audit_id STRING, pack_id STRING, has_data_difference INT, has_template_difference INT, has_read_difference INT, has_write_difference INT"


def test_pairs(spark, rows):
    legacy = spark.createDataFrame(
        [("f", "Y:\\x\\m.map.xml", "T", 5, None), ("f", "plain.map.xml", "T", 1, 1), (None, "m.map.xml", "T", 1, 1), ("g", "x\\m.dtsx", "T", 1, 1)], LOG
    )
    new = spark.createDataFrame([("f", "Z:\\m.dtsx", "N", 3, 2), ("f", "plain.dtsx", "N", 1, 1), (None, "m.dtsx", "N", 1, 1), ("g", "m.dtsx", "N", 1, 1)], LOG)
    diffs = reconcile.count_diffs(reconcile.pair_loads(legacy, new))
    assert rows(diffs.select("legacy_map", "new_package", "legacy_table", "new_table", "read_diff", "write_diff")) == [
        ("m.map.xml", "m.dtsx", "dbo.T", "N", 2, None),
        ("plain.map.xml", "plain.dtsx", "dbo.T", "N", 0, 0),
    ]


def test_pairs_with_collation(spark):
    legacy = spark.createDataFrame([("F ", "d\\M.map.xml", "T", 1, 1)], LOG)
    new = spark.createDataFrame([("f", "d\\m.dtsx", "N", 1, 1)], LOG)
    assert reconcile.pair_loads(legacy, new).count() == 0
    assert reconcile.pair_loads(legacy, new, collation="UTF8_LCASE_RTRIM").count() == 1


def test_flags_without_pairs_equal_flags_from_pairs(spark, rows):
    rng = random.Random(7)

    def log(suffix, table):
        return spark.createDataFrame(
            [
                (rng.choice(["f1", "f2", "f3", None]), f"d\\m{rng.randint(1, 3)}{suffix}", f"{table}{rng.randint(1, 3)}",
                 rng.choice([1, 1, 1, 2, None]), rng.choice([1, 1, 1, 1, 1, 1, None]))
                for _ in range(25)
            ],
            LOG,
        )

    packages = spark.createDataFrame(
        [("a", str(10 * i + j), rng.choice(["X", "Y"]), f"dbo.T{i}", f"N{j}") for i in (1, 2, 3, 4) for j in (1, 2, 3)]
        + [("a", "11", "X", "dbo.T2", "N2")],
        PACKAGES,
    )
    flags = spark.createDataFrame([("a", str(n), 0, 0, 7, 8) for n in range(9, 45)] + [("b", "11", 0, 0, 7, 8)], FLAGS)
    for _ in range(2):
        legacy, new = log(".map.xml", "T"), log(".dtsx", "N")
        for audit in (None, "X"):
            details = reconcile.reconcile(legacy, new, packages, audit)
            assert rows(reconcile.update_flags(flags, details)) == rows(
                reconcile.reconcile_flags(flags, legacy, new, packages, audit)
            )


def test_hot_file_does_not_multiply(spark):
    """20,000 loads of one file on either side would be 400 million pairs."""
    hot = "concat('d\\\\m', '{}') AS map_name"
    legacy = spark.range(20_000).selectExpr("'f' AS file_name", hot.format(".map.xml"), "'T' AS table_name", "id AS records_read", "1L AS records_written")
    new = spark.range(20_000).selectExpr("'f' AS file_name", hot.format(".dtsx"), "'N' AS table_name", "id AS records_read", "1L AS records_written")
    packages = spark.createDataFrame([("a", "1", "X", "dbo.T", "N")], PACKAGES)
    flags = spark.createDataFrame([("a", "1", 0, 0, 0, 1)], FLAGS)
    found = reconcile.reconcile_flags(flags, legacy, new, packages).first()
    assert (found.has_read_difference, found.has_write_difference) == (1, 0)


def test_flags_equal_those_of_the_pairs(spark, rows):
    legacy = spark.createDataFrame([("f", "d\\m.map.xml", "T", 5, 1), ("g", "d\\m.map.xml", "T", 1, 1)], LOG)
    new = spark.createDataFrame([("f", "d\\m.dtsx", "N", 3, 1), ("g", "d\\m.dtsx", "M", 1, None)], LOG)
    packages = spark.createDataFrame([("a", "1", "X", "dbo.T", "N"), ("a", "2", "X", "dbo.T", "M")], PACKAGES)
    flags = spark.createDataFrame([("a", "1", 0, 0, 7, 8), ("a", "2", 0, 0, 7, 8)], FLAGS)
    expected = [("a", "1", 0, 0, 1, 0), ("a", "2", 0, 0, 0, 1)]
    assert rows(reconcile.reconcile_flags(flags, legacy, new, packages)) == expected
    assert rows(reconcile.update_flags(flags, reconcile.reconcile(legacy, new, packages))) == expected


def test_clients_do_not_mix(spark, rows):
    """Two clients load files of one name by maps of one name, each with equal counts in both engines."""
    log = LOG + ", tracker_db STRING"
    legacy = spark.createDataFrame([("f", "d\\m.map.xml", "T", 5, 5, "dbA"), ("f", "d\\m.map.xml", "T", 9, 9, "dbB")], log)
    new = spark.createDataFrame([("f", "d\\m.dtsx", "N", 5, 5, "dbA"), ("f", "d\\m.dtsx", "N", 9, 8, "dbB")], log)
    packages = spark.createDataFrame([("a", "1", "A", "dbo.T", "N"), ("b", "2", "B", "dbo.T", "N")], PACKAGES).withColumn("phase", F.lit("1 "))
    clients = spark.createDataFrame([("A", "1", "dbA"), ("B", "1", "dbB"), ("B", "2", "dbA")], "audit_name STRING, phase STRING, tracker_db STRING")
    keyed = reconcile.with_tracker_db(packages, clients)
    flags = spark.createDataFrame([("a", "1", 0, 0, None, None), ("b", "2", 0, 0, None, None)], FLAGS)
    expected = [("a", "1", 0, 0, 0, 0), ("b", "2", 0, 0, 0, 1)]
    assert rows(reconcile.reconcile_flags(flags, legacy, new, keyed)) == expected
    details = reconcile.reconcile(legacy, new, keyed)
    assert details.count() == 2 and rows(reconcile.update_flags(flags, details)) == expected
    assert reconcile.pair_loads(legacy, new).count() == 2
