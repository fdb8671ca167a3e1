"""Data tests: one failing row each, severities, enforcement."""

import pytest

from farelane.operators import quality as D


def test_checks_find_one_failure_each(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), (None, 999, 0), ("b", 1, 3)],
                               "tripid string, loc bigint, payment_type bigint")
    zones = spark.createDataFrame([(1,), (2,), (3,)], "locationid bigint")
    assert [tuple(r) for r in D.check_unique(df, "tripid").collect()] == [("a", 2)]
    assert D.check_not_null(df, "tripid").count() == 1
    assert [r.from_field for r in D.check_relationship(df, "loc", zones, "locationid").collect()] == [999]
    assert [tuple(r) for r in D.check_accepted(df, "payment_type", [1, 2, 3, 4, 5, 6]).collect()] == [(0, 1)]


def test_run_checks_and_enforce(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "tripid string")
    report = D.run_checks([D.CheckSpec("u", D.check_unique(df, "tripid"), "warn"),
                           D.CheckSpec("nn", D.check_not_null(df, "tripid"), "error"),
                           D.CheckSpec("ok", D.check_not_null(df.where("tripid is not null"), "tripid"), "error")])
    got = {r.check: (r.failures, r.status) for r in report.collect()}
    assert got == {"u": (1, "warn"), "nn": (1, "error"), "ok": (0, "pass")}
    with pytest.raises(D.DataTestError):
        D.enforce(report)
    D.enforce(report.where("check != 'nn'"))


def test_table_suite_counts_as_the_single_checks(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), (None, 999, 0), ("b", 1, 3), ("c", None, 0), ("d", 998, 9)],
                               "tripid string, loc bigint, payment_type bigint")
    zones = spark.createDataFrame([(1,), (2,), (2,), (None,)], "locationid bigint")
    t = D.TableTests("t", df, unique=[("tripid", "warn")], not_null=[("tripid", "error")],
                     relationships=[("loc", zones, "locationid", "warn")], accepted=[("payment_type", [1, 2, 3], "warn")])
    got = {r.check: (r.failures, r.status) for r in D.run_tables([t]).collect()}
    assert got == {"t.tripid.unique": (1, "warn"), "t.tripid.not_null": (1, "error"),
                   "t.loc.relationships": (2, "warn"), "t.payment_type.accepted_values": (2, "warn")}
    empty = D.TableTests("t", df.limit(0), t.unique, t.not_null, t.relationships, t.accepted)
    assert {r.status for r in D.run_tables([empty]).collect()} == {"pass"}
