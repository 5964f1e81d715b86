"""Upserts whose batch is about as large as the table, and what the star flow leaves on disk. On invented pots."""

import datetime as dt
import os

import pytest

from conftest import rows
from strata.functions.calendar import MONTH_NAMES_PT, WEEKDAY_NAMES_PT
from strata.plans.layered import star_schema_flow
from strata.sources import table as tables
from strata.sources.table import Table

DDL = "pot long, glaze string, weight double"
FIRST = [(1, "ash", 1.5), (2, None, 2.5), (3, "salt", 0.0), (None, "tin", 4.0)]


def load(spark, path, first, second, **options):
    t = Table(spark, path)
    t.publish(spark.createDataFrame(first, DDL))
    t.upsert(spark.createDataFrame(second, DDL), ["pot"], **options)
    return t


@pytest.mark.parametrize(("second", "want", "counts"), [
    ([(1, "ash", 1.5), (2, "lead", 2.5), (3, "salt", -0.0), (None, "tin", 4.0), (5, "x", None)], None, (1, 1)),
    ([(2, None, None), (3, "salt", 0.0)], [(1, "ash", 1.5), (2, None, None), (3, "salt", 0.0), (None, "tin", 4.0)], (0, 1)),
])
def test_large_batch_is_written_as_staged(spark, tmp, monkeypatch, second, want, counts):
    def refused(*a, **k):
        raise AssertionError("whole rows were joined")

    monkeypatch.setattr(tables, "_keyed_merge", refused)
    t = load(spark, f"{tmp}/t", FIRST, second)
    assert sorted(map(str, rows(t.read()))) == sorted(map(str, want or second))
    last = t.history().orderBy("version").collect()[-1]
    assert (last["version"], last["n_inserted"], last["n_updated"]) == (2, *counts)


@pytest.mark.parametrize(("first", "second", "options", "want", "versions"), [
    (FIRST, FIRST, {}, FIRST, [1]),                                                        # nothing differs
    ([(1, "a", 1.0), (1, "b", 2.0)], [(1, "c", 3.0)], {}, [(1, "c", 3.0), (1, "c", 3.0)], [1, 2]),  # repeated in the table
    (FIRST, [(1, None, 9.0), (2, "q", None), (3, None, None)], {"coalesce_existing": True},
     [(1, "ash", 9.0), (2, "q", 2.5), (3, "salt", 0.0), (None, "tin", 4.0)], [1, 2]),
    (FIRST, [(None, "z", 1.0), (3, "y", 1.0)], {"null_safe": False},
     [(1, "ash", 1.5), (2, None, 2.5), (3, "y", 1.0), (None, "tin", 4.0), (None, "z", 1.0)], [1, 2]),
])
def test_other_upserts_stay_as_they_were(spark, tmp, first, second, options, want, versions):
    t = load(spark, f"{tmp}/t", first, second, **options)
    assert rows(t.read()) == sorted(want, key=lambda r: tuple((x is None, str(x)) for x in r)) and t.versions() == versions


def test_star_flow_leaves_nothing_staged(spark, tmp):
    def staged_files():
        top = spark.sparkContext.getCheckpointDir().removeprefix("file:")
        return {os.path.join(at, f) for at, _, names in os.walk(top) for f in names}

    before = staged_files()
    jobs = spark.createDataFrame([("j1", "m1", "s4", dt.date(2031, 1, 15))], "job string, smith string, shop string, day date")
    for owner, version in (("guild", "2031-01-31"), ("family", "2031-02-28")):
        out = star_schema_flow(
            spark, jobs, "job", [("smith", spark.createDataFrame([("m1", "Odile")], "smith string, name string"), "smith", ["name"], "smith")],
            ("shop", spark.createDataFrame([("s4", owner)], "shop string, owner string"), "shop", ["owner"], "shop", "day"), f"{tmp}/gold",
            ("2031-01-01", "2031-12-31", MONTH_NAMES_PT, WEEKDAY_NAMES_PT), version, version, keep=["job", "smith_sk", "shop_sk"])
    assert out.count() == 1 and staged_files() == before
