"""Dimensions and facts, on invented workshops and repair jobs: SCD1 keys,
SCD2 versions, calendar, as-of join at the boundaries, star flow run twice."""

import datetime as dt
import hashlib

import pytest

from conftest import rows
from strata.functions.calendar import MONTH_NAMES_PT, WEEKDAY_NAMES_PT
from strata.functions.keys import fingerprint, legacy_fingerprint
from strata.operators import checks, dims, facts
from strata.plans.layered import star_schema_flow
from strata.sources.table import Table

SHOP = "shop string, trade string, quay string, owner string"
ATTRS = ["trade", "quay", "owner"]


def shops(spark, *data):
    return spark.createDataFrame(list(data), SHOP)


def test_scd1_key_is_sha256_of_id(spark):
    r = dims.scd1_dim(spark.createDataFrame([("k-9", "Lathe")], "tool string, label string"), "tool").first()
    assert r["tool_sk"] == hashlib.sha256(b"k-9").hexdigest()


def test_scd2_first_load_noop_and_change(spark):
    v1 = shops(spark, ("s4", "rope", "north", "guild"))
    dim = dims.scd2_init(v1, "shop", ATTRS, "2031-01-01 00:00:00", sk_col="sk")
    [r] = dim.collect()
    assert r["is_current"] and r["valid_to"] is None and r["valid_from"] == dt.date(1900, 1, 1)
    assert rows(dims.scd2_apply(dim, v1, "shop", ATTRS, "2031-02-01", "2031-02-01 00:00:00", sk_col="sk")) == rows(dim)
    out = dims.scd2_apply(dim, shops(spark, ("s4", "rope", "north", "family")), "shop", ATTRS, "2031-02-01", "2031-02-01 00:00:00", sk_col="sk")
    got = {r["owner"]: r for r in out.collect()}
    assert len(got) == 2 and got["family"]["is_current"] and not got["guild"]["is_current"]
    assert got["guild"]["valid_to"] == got["family"]["valid_from"] == dt.date(2031, 2, 1) and got["guild"]["sk"] != got["family"]["sk"]
    c = checks.check_scd2(out, "shop").first()
    assert (c["n_versions"], c["n_active"], c["n_overlaps"], c["n_gaps"]) == (2, 1, 0, 0)


def test_scd2_natural_keys_are_unique_and_present(spark):
    good, twice, missing = (shops(spark, *x) for x in ([("a", "x", "y", "z")], [("a", "x", "y", "z"), ("a", "x", "y", "q")],
                                                        [("a", "x", "y", "z"), (None, "x", "y", "z")]))
    dim = dims.scd2_init(good, "shop", ATTRS, "t1")
    for bad in (twice, missing):
        with pytest.raises(dims.NaturalKeyError):
            dims.scd2_init(bad, "shop", ATTRS, "t1")
        with pytest.raises(dims.NaturalKeyError):
            dims.scd2_apply(dim, bad, "shop", ATTRS, "2031-02-01", "t2")


def test_scd2_close_missing_and_validate(spark):
    dim = dims.scd2_init(shops(spark, ("a", "A", "x", "p"), ("b", "B", "y", "q")), "shop", ATTRS, "t1")
    out = dims.scd2_apply(dim, shops(spark, ("a", "A", "x", "p")), "shop", ATTRS, "2031-03-01", "t2", close_missing=True)
    assert rows(out.where("is_current"), "shop") == [("a",)]
    later = dims.scd2_apply(dim, shops(spark, ("a", "A", "x", "z")), "shop", ATTRS, "2031-03-01", "t2")
    with pytest.raises(dims.EffectiveDateError):
        dims.scd2_apply(later, shops(spark, ("a", "A", "x", "w")), "shop", ATTRS, "2031-01-01", "t3")


def test_fingerprint_is_null_aware_legacy_is_not(spark):
    df = spark.createDataFrame([("a", "b", None), ("a", None, "b")], "x string, y string, z string")
    leg = [r[0] for r in df.select(legacy_fingerprint(["x", "y", "z"])).collect()]
    new = [r[0] for r in df.select(fingerprint(["x", "y", "z"])).collect()]
    assert leg[0] == leg[1] and new[0] != new[1]


def test_calendar(spark):
    cal = dims.calendar_dim(spark, "2032-01-01", "2032-12-31", MONTH_NAMES_PT, WEEKDAY_NAMES_PT)
    assert cal.count() == 366
    first, last = cal.where("date = date'2032-01-01'").first(), cal.where("date = date'2032-12-31'").first()
    assert (first["date_sk"], first["month"], first["period"], first["month_name"], first["quarter"]) == (20320101, 1, 1, "Janeiro", 1)
    assert first["weekday_name"] == "Quinta-feira" and (last["period"], last["month_name"]) == (6, "Dezembro")
    plain = dims.calendar_dim(spark, "2032-01-01", "2032-01-01", list("abcdefghijkl"), list("ABCDEFG"), period_months=3).first()
    assert (plain["month_name"], plain["weekday_name"], plain["period"]) == ("a", "E", 1)


def test_asof_boundaries(spark):
    dim = spark.createDataFrame([("k", "v1", dt.date(1900, 1, 1), dt.date(2031, 1, 1)), ("k", "v2", dt.date(2031, 1, 1), None)],
                                "key string, ver string, valid_from date, valid_to date")
    fact = spark.createDataFrame([(1, "k", dt.date(2030, 12, 31)), (2, "k", dt.date(2031, 1, 1)), (3, "k", dt.date(2031, 1, 2)),
                                  (4, "zz", dt.date(2031, 1, 2))], "id int, key string, day date")
    assert rows(facts.asof_version_join(fact, dim, "key", "day", ["ver"]), "id", "ver") == [(1, "v1"), (2, "v2"), (3, "v2"), (4, None)]


def test_fact_percent_and_zero_denominator(spark):
    f = spark.createDataFrame([("j1", 6.5, 10.0), ("j2", 1.0, 0.0)], "job string, done double, due double")
    assert dict(rows(f.select("job", facts.ratio_pct("done", "due").alias("pct")))) == {"j1": 65.0, "j2": None}


def test_star_flow_twice_with_a_changed_attribute(spark, tmp):
    ddl = "job string, smith string, shop string, tool string, day date, done double, due double"
    jobs = [("j1", "m1", "s4", "t1", dt.date(2031, 1, 15), 8.5, 10.0)]
    smiths = spark.createDataFrame([("m1", "Odile")], "smith string, name string")
    tools = spark.createDataFrame([("t1", "Anvil")], "tool string, label string")

    def run(facts_in, shop_rows, version, effective):
        return star_schema_flow(
            spark, spark.createDataFrame(facts_in, ddl), "job",
            scd1=[("dim_smith", smiths, "smith", ["name"], "smith"), ("dim_tool", tools, "tool", ["label"], "tool")],
            scd2=("dim_shop", shops(spark, *shop_rows), "shop", ATTRS, "shop", "day"), base_path=f"{tmp}/gold",
            calendar=("2031-01-01", "2031-12-31", MONTH_NAMES_PT, WEEKDAY_NAMES_PT), version_ts=version, effective_date=effective,
            measures={"pct": facts.ratio_pct("done", "due")}, keep=["job", "smith_sk", "tool_sk", "shop_sk", "day", "pct"])

    old = [("s4", "rope", "north", "guild")]
    run(jobs, old, "2031-01-31 00:00:00", "2031-01-31")
    first = run(jobs, old, "2031-01-31 00:00:00", "2031-01-31")
    assert rows(first, "job", "pct") == [("j1", 85.0)] and Table(spark, f"{tmp}/gold/dim_shop").versions() == [1]
    assert Table(spark, f"{tmp}/gold/fact").versions() == [1]
    out = run(jobs + [("j2", "m1", "s4", "t9", dt.date(2031, 2, 3), 1.0, 4.0)], [("s4", "rope", "south", "guild")], "2031-02-01 00:00:00", "2031-02-01")
    by_job = {r["job"]: r for r in out.collect()}
    versions = {r["quay"]: r["shop_sk"] for r in Table(spark, f"{tmp}/gold/dim_shop").read().collect()}
    assert (by_job["j1"]["shop_sk"], by_job["j2"]["shop_sk"]) == (versions["north"], versions["south"])
    u = checks.unresolved_keys(out, ["smith_sk", "tool_sk", "shop_sk"]).first()
    assert (u["null_smith_sk"], u["null_tool_sk"], u["null_shop_sk"]) == (0, 1, 0)


def test_check_scd2_in_ranges_equals_plain_on_hot_key(spark):
    base = dt.date(2000, 1, 1)
    data = [("hot", base + dt.timedelta(days=i), base + dt.timedelta(days=i + 1), False) for i in range(3000)]
    data += [("hot", base + dt.timedelta(days=3000), None, True), ("hot", base + dt.timedelta(days=10), base + dt.timedelta(days=50), False)]
    data += [(f"k{i}", dt.date(1990, 1, 1), None, True) for i in range(20)]
    df = spark.createDataFrame(data, "k string, valid_from date, valid_to date, is_current boolean")
    split = checks.check_scd2(df, "k")
    assert rows(split) == rows(checks.check_scd2(df, "k", skew_safe=False))
    hot = split.where("k = 'hot'").first()
    assert (hot["n_versions"], hot["n_active"], hot["n_overlaps"], hot["n_gaps"]) == (3002, 1, 2, 0)


def test_scd2_key_first_seen_on_second_load(spark):
    dim = dims.scd2_init(shops(spark, ("s1", "sail", "east", "guild")), "shop", ATTRS, "t1")
    v2 = shops(spark, ("s1", "sail", "east", "guild"), ("s2", "mast", "west", "family"))
    late = dims.scd2_apply(dim, v2, "shop", ATTRS, "2031-02-01", "t2")
    assert late.where("shop = 's2'").first()["valid_from"] == dt.date(2031, 2, 1)  # earlier facts find no version
    early = dims.scd2_apply(dim, v2, "shop", ATTRS, "2031-02-01", "t2", new_key_start="1900-01-01")
    assert early.where("shop = 's2'").first()["valid_from"] == dt.date(1900, 1, 1) and early.where("shop = 's1'").count() == 1


def test_scd2_two_changes_on_one_day_leave_zero_length_version(spark):
    dim = dims.scd2_init(shops(spark, ("a", "A", "x", "p")), "shop", ATTRS, "t1")
    d1 = dims.scd2_apply(dim, shops(spark, ("a", "A", "x", "q")), "shop", ATTRS, "2031-03-01", "t2")
    d2 = dims.scd2_apply(d1, shops(spark, ("a", "A", "x", "r")), "shop", ATTRS, "2031-03-01", "t3")
    zero = d2.where("owner = 'q'").first()
    assert zero["valid_from"] == zero["valid_to"] == dt.date(2031, 3, 1)  # [d, d) never matches
    c = checks.check_scd2(d2, "shop").first()
    assert (c["n_versions"], c["n_active"], c["n_overlaps"], c["n_gaps"]) == (3, 1, 0, 0)
    fact = spark.createDataFrame([(1, "a", dt.date(2031, 3, 1))], "id int, shop string, day date")
    assert facts.asof_version_join(fact, d2, "shop", "day", ["owner"]).first()["owner"] == "r"
