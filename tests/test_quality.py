import pytest
from pyspark.sql import functions as F

from pulsehouse.operators import (assert_checks, assert_count, count_checks,
                                  create_database, create_tables, database_exists,
                                  drop_database, rows_equal, table_exists)
from pulsehouse.session import scratch_dir


def test_count_checks_report_both_numbers(spark):
    df = spark.range(10)
    checks = count_checks(spark, [
        ("all", df, 10),
        ("even", df, 4, "id % 2 = 0"),
        ("le", df.where("id < 3"), df, "true", "<="),
    ])
    got = {r.check: (r.expected, r.actual, r.ok) for r in checks.collect()}
    assert got == {"all": (10, 10, True), "even": (4, 5, False), "le": (10, 3, True)}
    with pytest.raises(AssertionError, match="expected 4, found 5"):
        assert_checks(checks)


def test_assert_count(spark):
    assert assert_count(spark.range(5), 2, "id >= 3") == 2
    with pytest.raises(AssertionError):
        assert_count(spark.range(5), 1, "id >= 3")


def test_rows_equal_multiset(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(1,), (2,), (3,)], "x int")
    r = rows_equal(a, b).first()
    assert (r.missing, r.extra) == (1, 1)
    r = rows_equal(a, a.orderBy(F.desc("x"))).first()
    assert (r.missing, r.extra) == (0, 0)


def test_database_lifecycle(spark):
    root = scratch_dir(spark, "test_db")
    create_database(spark, "ph_test_db", f"{root}/db")
    create_tables(spark, "ph_test_db", f"{root}/tables", names=["users", "bus_dump"])
    assert database_exists(spark, "ph_test_db")
    assert table_exists(spark, "users", "ph_test_db")
    parts = spark.sql("DESCRIBE TABLE EXTENDED ph_test_db.bus_dump").collect()
    assert any("week_part" in (r.col_name or "") for r in parts)
    spark.sql("USE default")
    assert drop_database(spark, "ph_test_db")
    assert not drop_database(spark, "ph_test_db")
