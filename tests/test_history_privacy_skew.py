"""History, masking, skew, grain-safe joins and the period questions, on
invented data: beehive weights, museum visitors, orchard harvests."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from strata.operators import checks, history, metrics, privacy, skew
from strata.sources.table import Table

HIST = "hive string, batch_seq long, kg double, op string"


def hist(spark):
    return spark.createDataFrame([
        ("oak", 1, 31.0, "upsert"), ("elm", 1, 24.5, "upsert"), ("ash", 1, 28.0, "upsert"),
        ("oak", 2, 33.5, "upsert"), ("ash", 2, 28.0, "upsert"), ("fir", 2, 19.0, "upsert"),
        ("elm", 3, None, "delete"), ("oak", 4, 36.0, "upsert")], HIST)


def test_as_of_versions_and_delete_marker(spark):
    assert rows(history.as_of(hist(spark), ["hive"], 1), "hive", "kg") == [("ash", 28.0), ("elm", 24.5), ("oak", 31.0)]
    assert rows(history.as_of(hist(spark), ["hive"], 3), "hive", "kg") == [("ash", 28.0), ("fir", 19.0), ("oak", 33.5)]


def test_a_write_records_its_history(spark, tmp):
    first = spark.createDataFrame([("oak", 31.0), ("elm", 24.5), (None, 1.0)], "hive string, kg double")
    second = spark.createDataFrame([("oak", 33.5), (None, 1.0), ("fir", 19.0)], "hive string, kg double")
    t = Table(spark, f"{tmp}/h")
    t.publish(history.record_upsert(None, first.limit(0), first, ["hive"], 1))
    t.publish(history.record_upsert(t.read(), first, second, ["hive"], 2))
    t.publish(history.record_upsert(t.read(), second, second, ["hive"], 3))  # an identical write records nothing
    assert rows(t.read().where("batch_seq > 1"), "hive", "op", "kg") == [("elm", "delete", 24.5), ("fir", "upsert", 19.0), ("oak", "upsert", 33.5)]
    for seq, state in ((1, first), (2, second), (3, second)):
        assert rows(history.as_of(t.read(), ["hive"], seq), "hive", "kg") == rows(state)


def test_change_log_of_one_record(spark):
    log = history.change_log(hist(spark).where("op = 'upsert'"), ["hive"], ["kg"])
    assert rows(log.where("hive = 'oak'"), "batch_seq", "prev_kg", "kg") == [(1, None, 31.0), (2, 31.0, 33.5), (4, 33.5, 36.0)]
    same = history.change_log(hist(spark).where("op = 'upsert'"), ["hive"], ["kg"], only_changes=False)
    assert rows(same.where("hive = 'ash'"), "batch_seq", "changed") == [(1, True), (2, False)]


def test_change_log_in_ranges_equals_plain(spark):
    data = [("hot", i, float(i // 3), "upsert") for i in range(900)] + [(f"c{i}" if i else None, i, 1.0, "upsert") for i in range(30)]
    h = spark.createDataFrame(data, HIST)
    assert rows(history.change_log(h, ["hive"], ["kg"], only_changes=False)) == rows(
        history.change_log(h, ["hive"], ["kg"], skew_safe=False, only_changes=False))


def test_summary_and_retention(spark):
    assert rows(history.change_history_summary(hist(spark), ["hive"]), "batch_seq", "op", "n_rows") == [
        (1, "upsert", 3), (2, "upsert", 3), (3, "delete", 1), (4, "upsert", 1)]
    # superseded by batch 3; rows current at the cutoff (also elm's delete) are kept
    assert rows(history.retention_candidates(hist(spark), ["hive"], 3), "hive", "batch_seq") == [("ash", 1), ("elm", 1), ("oak", 1)]


GUEST = "badge string, guest string, code string, mail string, spent double"
POLICY = {"badge": ("hash", ["curator"], {"salt": "pepper"}), "guest": ("partial", ["curator"], {"keep_start": 2}),
          "code": ("digits", ["curator"], {"keep_last": 3}), "mail": ("email", ["curator"]), "spent": ("null", ["curator", "shop"])}
AUDIENCES = ["shop", "desk", "curator"]


def guests(spark):
    return spark.createDataFrame([("b-77", "Quill Ostrander", "40-18-2256", "quill@lantern.example", 61.5)], GUEST)


def test_masking_per_audience(spark):
    shop = privacy.mask_columns(guests(spark), POLICY, "shop", AUDIENCES).first()
    assert shop["badge"] == hashlib.sha256(b"pepperb-77").hexdigest()
    assert (shop["guest"], shop["code"], shop["mail"], shop["spent"]) == ("Qu" + "*" * 13, "**-**-*256", "***@lantern.example", 61.5)
    assert privacy.mask_columns(guests(spark), POLICY, "desk", AUDIENCES).first()["spent"] is None
    assert privacy.mask_columns(guests(spark), POLICY, "curator", AUDIENCES).first()["code"] == "40-18-2256"
    stranger = privacy.mask_columns(guests(spark), POLICY, "stranger", AUDIENCES).first()
    assert all(stranger[c] is None for c in POLICY)


def test_masking_is_closed_by_default(spark):
    df = guests(spark)
    loud = privacy.mask_columns(df, {"MAIL": ("email", ["curator"])}, "shop", AUDIENCES)
    assert loud.columns == df.columns and loud.first()["mail"] == "***@lantern.example"
    for policy in ({"e_mail": ("email", ["curator"])}, {"badge": ("hash", ["curator"])}, {"badge": ("hash", ["curator"], {"salt": ""})}):
        for audience in ("shop", "curator"):
            with pytest.raises(privacy.PolicyError):
                privacy.mask_columns(df, policy, audience, AUDIENCES)
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        with pytest.raises(privacy.PolicyError):
            privacy.mask_columns(df, {"MAIL": ("email", ["curator"])}, "shop", AUDIENCES)
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


VISIT = "visit string, guest string, hall string, kind string"


def visits(spark):
    data = [(f"v{i}", f"g{i % 5}", "atrium", "tour" if i % 2 else "solo") for i in range(7)]
    return spark.createDataFrame(data + [("w1", "g9", "vault", "solo"), ("w2", "g9", "vault", None), ("x1", None, "attic", None)], VISIT)


def test_skew_is_measured_against_the_median(spark):
    data = [("hot", i) for i in range(1000)] + [(f"k{k}", i) for k in range(900) for i in range(10)]
    got = {r["k"]: r for r in skew.skew_report(spark.createDataFrame(data, "k string, i int"), ["k"]).collect()}
    assert got["hot"]["is_hot"] and got["hot"]["ratio_to_median"] == 100.0 and got["hot"]["share"] == 0.1
    assert not got["k7"]["is_hot"] and got["k7"]["ratio_to_median"] == 1.0
    assert not any(r["is_hot"] for r in skew.skew_report(visits(spark), ["hall"]).collect())
    assert any(r["is_hot"] for r in skew.skew_report(visits(spark), ["hall"], hot_ratio=3.5).collect())


@settings(max_examples=6, deadline=None)
@given(st.integers(min_value=1, max_value=40))
def test_salted_equals_plain_for_any_salts(spark, salts):
    df = visits(spark).withColumn("n", F.length("visit"))
    kw = dict(sums=["n"], counts=["kind"], mins=["n"], maxs=["visit"], distincts=["guest", "kind"])
    plain = skew.plain_aggregate(df, ["hall"], **kw)
    assert rows(plain) == rows(skew.salted_aggregate(df, ["hall"], salts, **kw).select(*plain.columns))


HARVEST = "grower string, plot string, crop string, season int, tons double"
RAIN = "grower string, plot string, season int, mm double"


def test_grain_trap_and_double_decline(spark):
    harvest = spark.createDataFrame([
        ("Ines", "p1", "plum", 1, 4.0), ("Ines", "p1", "plum", 2, 5.5), ("Bo", "p2", "plum", 1, 6.0), ("Bo", "p2", "plum", 2, 3.0),
        ("Bo", "p2", "pear", 1, 2.0), ("Bo", "p2", "pear", 2, 2.5), ("Kai", "p3", "plum", 1, 1.0), ("Kai", "p3", "plum", 2, 1.5)], HARVEST)
    rain = spark.createDataFrame([("Ines", "p1", 1, 300.0), ("Ines", "p1", 2, 250.0), ("Bo", "p2", 1, 280.0), ("Bo", "p2", 2, 200.0),
                                  ("Kai", "p3", 1, 150.0), ("Kai", "p3", 2, 190.0)], RAIN)
    fan = checks.fanout_report(rain, harvest, ["grower", "season"]).first()
    joined = rain.join(harvest, ["grower", "season"])
    assert fan["fanout"] and (fan["rows_before"], fan["rows_after"], fan["keys_after"], fan["max_rows_per_key"]) == (6, joined.count(), 6, 2)
    assert not checks.fanout_report(harvest, rain, ["grower", "season"]).first()["fanout"]
    safe = metrics.grain_safe_join(harvest, rain, ["grower", "crop", "season"], {"tons": F.avg("tons")}, {"mm": F.avg("mm")},
                                   right_grain=["grower", "season"], how="left")
    assert safe.count() == 8 == safe.select("grower", "crop", "season").distinct().count()
    change = metrics.period_change(safe.where("crop = 'plum'"), ["grower"], "season", 1, 2,
                                   {m: lambda c, m=m: F.max(F.when(c, F.col(m))) for m in ("tons", "mm")})
    assert rows(metrics.double_decline(change, "tons", "mm"), "grower") == [("Bo",)]
    risk = {r["crop"]: r for r in metrics.at_risk(harvest, ["grower"], ["crop"], "tons", 2.0).collect()}
    assert (risk["plum"]["n_at_risk"], risk["plum"]["n_entities"], risk["pear"]["n_at_risk"]) == (1, 3, 0)
    vs = {r["grower"]: r for r in metrics.vs_population(harvest, ["grower"], "tons").collect()}
    assert (vs["Kai"]["entity_mean"], vs["Kai"]["population_mean"], vs["Kai"]["diff_from_population"]) == (1.25, 3.19, -1.94)


def test_null_grain_values_match_each_other(spark):
    left = spark.createDataFrame([(None, "a", 1), (None, "b", 1), ("x", "a", 2)], "g string, sub string, v int")
    right = spark.createDataFrame([(None, 5), (None, 6), ("y", 7)], "g string, w int")
    got = metrics.grain_safe_join(left, right, ["g", "sub"], {"v": F.sum("v")}, {"w": F.sum("w")}, right_grain=["g"])
    assert rows(got) == [("x", "a", 2, None), ("y", None, None, 7), (None, "a", 1, 11), (None, "b", 1, 11)]
    equal = metrics.grain_safe_join(left, right, ["g"], {"v": F.sum("v")}, {"w": F.sum("w")})
    assert rows(equal) == [("x", 2, None), ("y", None, 7), (None, 2, 11)]


def test_top_groups_tie_break(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 2.0), ("d", None)], "g string, r double")
    assert rows(metrics.top_groups(df, "r", 2, ["g"]), "g") == [("b",), ("c",)]
