"""Ordered operators, cohort reads, metrics and drift against brute force."""

from __future__ import annotations

import math
import random
import statistics
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from riskloom import constants as K
from riskloom.functions import numbers as N
from riskloom.streaming import histories as HI, rates as RT
from riskloom.operators import (
    cohort as C, decisions as DC, drift as DR, explain as E, ordered as R, quality as Q, scoring_metrics as M,
    splitting as S,
)


def skewed(spark, n=6000, seed=3):
    """A third of the rows share one key, another third one value."""
    rng = random.Random(seed)
    rows = [
        (i, "hot" if i % 3 == 0 else f"g{rng.randrange(9)}", 0.5 if i % 3 == 1 else rng.random(), int(rng.random() < 0.3))
        for i in range(n)
    ]
    return rows, spark.createDataFrame(rows, "id long, g string, s double, y int").repartition(7)


def test_order_statistics_are_exact(spark):
    rows, df = skewed(spark)
    out = R.order_statistics(df, ["g"], "s", {**R.median_picks(), **R.upper_decile_picks()}).select(
        "g", "n", R.median_value().alias("m"), R.upper_decile_value().alias("d")
    )
    for r in out.collect():
        xs = [s for _, g, s, _ in rows if g == r["g"]]
        assert r["n"] == len(xs)
        assert r["m"] == pytest.approx(statistics.median(xs), abs=1e-12)
        assert r["d"] == pytest.approx(statistics.quantiles(xs, n=10)[8], abs=1e-12)


def test_linear_quantiles_match_numpy(spark):
    rows, df = skewed(spark)
    probs = [i / 10 for i in range(1, 10)]
    out = R.order_statistics(df, [], "s", R.linear_picks(probs))
    got = out.select(*[R.linear_value(i, p).alias(str(i)) for i, p in enumerate(probs)]).first()
    assert list(got) == pytest.approx(list(np.quantile([r[2] for r in rows], probs)), abs=1e-12)


def test_order_key_sorts_like_the_doubles(spark):
    rng = random.Random(4)
    special = [0.0, -0.0, 5e-324, -5e-324, 2.0**-1022, 1.7976931348623157e308, -1.7976931348623157e308, math.inf, -math.inf]
    powers = [s * math.nextafter(2.0**e, d) for e in range(-1074, 1024, 37) for s in (1, -1) for d in (0, 2.0**e, math.inf)]
    xs = special + powers + [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(2000)]
    xs = [x for x in xs if not math.isnan(x)]
    df = spark.createDataFrame([(x,) for x in xs + [math.nan]], "x double").select("x", R.order_key("x", T.DoubleType()).alias("k"))
    got = [(r["x"], r["k"]) for r in df.collect()]
    assert got[-1][1] == (1 << 63) - 1
    for x, k in got[:-1]:
        bits = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
        assert k == (-bits if x < 0 else bits)


@pytest.mark.parametrize("kind", ["long", "date", "timestamp", "decimal(12,3)", "float", "int"])
def test_order_statistics_of_other_types(spark, kind):
    df = spark.range(1001).select((F.col("id") * 7919 % 1001).alias("i"))
    value = F.date_add(F.lit("1970-01-01").cast("date"), (F.col("i") - 500).cast("int")) if kind == "date" else (F.col("i") - 500).cast(kind)
    out = R.order_statistics(df.select(value.alias("v")), [], "v", {"first": lambda n: F.lit(1), "mid": R.median_picks()["_m1"], "none": lambda n: n + 1})
    want = df.select(value.alias("v")).agg(F.min("v"), F.expr("sort_array(collect_list(v))[500]")).first()
    r = out.first()
    assert (r["first"], r["mid"], r["none"], r["n"]) == (*want, None, 1001)


def test_a_group_with_nearly_all_rows_is_counted_not_sorted(spark):
    df = spark.range(300_000).select(
        F.when(F.col("id") % 100 == 0, F.col("id") % 7).otherwise(-1).alias("g"), F.pmod(F.xxhash64("id"), F.lit(10**9)).cast("double").alias("s")
    ).withColumn("s", F.when(F.col("s") % 3 == 0, 17.25).otherwise(F.col("s") / 1e3))
    out = R.order_statistics(df, ["g"], "s", {**R.median_picks(), **R.upper_decile_picks()})
    want = df.groupBy("g").agg(F.count("s").alias("n"), F.expr("percentile(s, 0.5)").alias("m"), F.expr("sort_array(collect_list(s))").alias("all"))
    got = {r["g"]: r for r in out.withColumn("m", R.median_value()).collect()}
    for r in want.collect():
        low = max(1, min(r["n"] - 1, (r["n"] + 1) * 9 // 10))
        assert (got[r["g"]]["n"], got[r["g"]]["m"], got[r["g"]]["_d1"]) == (r["n"], r["m"], r["all"][low - 1])


def test_null_keys_and_tiny_groups(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 7.0), ("b", None)], "g string, s double")
    out = R.order_statistics(df, ["g"], "s", {**R.median_picks(), **R.upper_decile_picks()})
    got = {r["g"]: (r["n"], r["m"], r["d"]) for r in out.select(
        "g", "n", R.median_value().alias("m"), R.upper_decile_value().alias("d")).collect()}
    assert got == {None: (2, 2.0, pytest.approx(statistics.quantiles([1.0, 3.0], n=10)[8])), "a": (1, 7.0, 7.0), "b": (0, None, None)}


@pytest.mark.parametrize("parts", [1, 5, 13])
def test_global_rank_does_not_depend_on_partitions(spark, parts):
    rows, df = skewed(spark, 2000)
    out = R.global_rank(df.repartition(parts), [F.col("s").desc(), F.col("id")], "r")
    want = {r[0]: i + 1 for i, r in enumerate(sorted(rows, key=lambda r: (-r[2], r[0])))}
    assert {r["id"]: r["r"] for r in out.collect()} == want


def test_running_totals_by_group(spark):
    rows, df = skewed(spark, 3000)
    per = df.groupBy("g", "s").agg(F.count(F.lit(1)).alias("c"))
    got = {(r["g"], r["s"]): r["t"] for r in R.running_totals(per, ["g"], "s", {"t": "c"}, descending=True).collect()}
    for (g, s), t in list(got.items())[:200]:
        assert t == sum(1 for _, h, x, _ in rows if h == g and x >= s)


def test_previous_row_crosses_slices(spark):
    rows, df = skewed(spark, 500)
    out = R.previous_row(df, ["g"], ["id"], F.floor(F.col("id") / 50), ["s"])
    seen, want = {}, {}
    for i, g, s, _ in rows:
        want[i] = seen.get(g)
        seen[g] = s
    got = {r["id"]: (r["previous"]["s"] if r["previous"] else None) for r in out.collect()}
    assert got == want


def test_cut_index_matches_searchsorted(spark):
    edges = K.threshold_grid()
    xs = [*edges, 0.0, 1.0, 0.0499999, 0.3, 0.3000001, float("nan")]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in xs], "x double").select(N.cut_index("x", edges)).collect()]
    assert got[:-1] == list(np.searchsorted(edges, xs[:-1], side="right"))


# --- cohort -----------------------------------------------------------------


def test_small_groups_are_pooled_or_dropped(spark):
    rows = [("Informatique", i / 10, i % 2) for i in range(8)] + [("Droit", 0.4, 1)] * 3 + [("nan", 0.2, 0)] * 2
    df = spark.createDataFrame(rows, "filiere string, p double, a int")
    got = {r["filiere"]: r for r in C.group_statistics(df, "filiere", "p", "a").collect()}
    assert set(got) == {"Informatique", K.SMALL_GROUPS_LABEL}
    assert got["Informatique"]["proba_decile_sup"] == pytest.approx(statistics.quantiles([i / 10 for i in range(8)], n=10)[8])
    assert got[K.SMALL_GROUPS_LABEL]["effectif"] == 5 and got[K.SMALL_GROUPS_LABEL]["hidden_groups"] == 2
    few = df.where("filiere <> 'nan'")
    assert [r["filiere"] for r in C.group_statistics(few, "filiere", "p", "a").collect()] == ["Informatique"]


def test_scope_join_and_latest(spark):
    scores = spark.createDataFrame(
        [(1, "b", "x", 0.2, 0), (2, "b", "x", 0.9, 1), (3, "b", "y", 0.5, 1), (4, "b", None, 0.1, 0), (5, "b", None, 0.3, 0)],
        "id int, batch_id string, student_id string, p double, alerte int",
    )
    silver = spark.createDataFrame([("b", "x", "Gestion"), ("b", "y", "Droit")], "batch_id string, student_id string, filiere string")
    latest = C.latest_per(scores, ["batch_id", "student_id"], [F.col("id").desc()])
    assert sorted(r["id"] for r in latest.collect()) == [2, 3, 5]
    on = ["batch_id", "student_id"]
    assert C.with_groups(latest, silver, on, "filiere").count() == 3
    assert [r["id"] for r in C.with_groups(latest, silver, on, "filiere", ["Gestion"]).collect()] == [2]
    assert C.with_groups(latest, silver, on, "filiere", []).count() == 0
    page = C.page(latest, "p", "id", 2, 2).collect()
    assert [(r["id"], r["rank"]) for r in page] == [(5, 3)]
    info = C.page_info(latest, 2, 2).first()
    assert (info["total"], info["alerts"], info["pages"], info["has_next"]) == (3, 2, 2, False)
    assert C.top_coverage(latest, "p", "id", 1).first()["coverage"] == 0.5


def test_latest_per_prunes_before_the_shuffle(spark):
    plan = C.latest_per(skewed(spark, 10)[1], ["g"], [F.col("id").desc()])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


# --- metrics ----------------------------------------------------------------


def test_threshold_prefers_recall(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.4), (1, 0.45), (1, 0.9)], "y int, s double")
    best = M.cheapest_threshold(df, "y", "s", thresholds=[0.3, 0.5]).first()
    assert (best["threshold"], best["fn"], best["recall"]) == (0.3, 0, 1.0)


def test_curve_metrics_match_brute_force(spark):
    rows, df = skewed(spark, 900)
    pos, neg = [r[2] for r in rows if r[3]], [r[2] for r in rows if not r[3]]
    auc = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert M.roc_auc(df, "y", "s").first()["auc"] == pytest.approx(auc, abs=1e-12)
    ap, tp, m = 0.0, 0, 0
    for s in sorted({r[2] for r in rows}, reverse=True):
        p = sum(1 for x in pos if x == s)
        tp, m = tp + p, m + p + sum(1 for x in neg if x == s)
        ap += p / len(pos) * tp / m
    assert M.average_precision(df, "y", "s").first()[0] == pytest.approx(ap, abs=1e-12)
    curve = M.threshold_curve(df, "y", "s").collect()
    assert len(curve) == 181
    for r in curve[::30]:
        assert r["fn"] == sum(1 for p in pos if p < r["threshold"]) and r["fp"] == sum(1 for q in neg if q >= r["threshold"])


def test_subgroup_gap(spark):
    df = spark.createDataFrame(
        [("F", 1, 1, 1), ("F", 0, 1, 1), ("M", 1, 1, 1), ("M", 0, 1, 0), (None, None, 0, 1)], "sexe string, boursier int, y int, f int"
    )
    assert M.largest_recall_gap(df, ["sexe", "boursier"], "y", "f").first()[0] == 0.5
    got = {(r["column"], r["value"]): r["recall"] for r in M.subgroup_recalls(df, ["sexe"], "y", "f").collect()}
    assert got == {("sexe", "F"): 1.0, ("sexe", "M"): 0.5}


def test_cost_table(spark):
    df = spark.createDataFrame([("lr", 0.950, 1.0), ("gb", 0.951, 10.0), ("rf", 0.94, 20.0)], "m string, auc double, t double")
    got = {r["m"]: r for r in M.cost_table(df, "m", "auc", "t", "lr").collect()}
    assert got["gb"]["cost_ratio"] == 10 and got["gb"]["cost_per_point"] == pytest.approx(9000)
    assert math.isinf(got["rf"]["cost_per_point"])


def test_quality_measures(spark):
    df = spark.createDataFrame([(1, float("nan"), None), (1, float("nan"), None), (2, 1.0, "x")], "a int, b double, c string")
    assert tuple(Q.duplicate_count(df).first()) == (3, 1)
    assert {r[0]: round(r[1], 4) for r in Q.missing_rates(df).collect()} == {"b": 0.6667, "c": 0.6667}


# --- drift ------------------------------------------------------------------


def psi_by_hand(ref, cur, bins=10, eps=1e-6):
    edges = np.unique(np.quantile(ref, np.linspace(0, 1, bins + 1)))
    if len(edges) < 3:
        low, high = min(*ref, *cur), max(*ref, *cur)
        if low == high:
            return 0.0
        edges = np.linspace(low, high, bins + 1)
    inner = edges[1:-1]

    def shares(x):
        return np.clip(np.bincount(np.searchsorted(inner, x, side="right"), minlength=len(inner) + 1) / len(x), eps, None)

    r, c = shares(ref), shares(cur)
    return float(np.sum((c - r) * np.log(c / r)))


def test_psi_matches_brute_force_and_is_zero_on_itself(spark):
    rng = np.random.default_rng(1)
    ref = {"a": rng.normal(size=400), "b": rng.integers(0, 2, 400) * 1.0, "c": np.full(400, 3.0), "d": rng.exponential(size=400)}
    cur = {"a": rng.normal(0.5, size=300), "b": rng.integers(0, 4, 300) * 1.0, "c": np.full(300, 3.0), "d": rng.exponential(size=300)}

    def frame(x):
        return spark.createDataFrame([tuple(float(v) for v in row) for row in zip(*x.values())], "a double, b double, c double, d double")

    left, right = frame(ref), frame(cur)
    got = {r["feature"]: r["psi"] for r in DR.psi(left, right, list("abcd")).collect()}
    for c in "abcd":
        assert got[c] == pytest.approx(psi_by_hand(ref[c], cur[c]), abs=1e-9)
    assert all(abs(r["psi"]) < 1e-12 for r in DR.psi(left, left, list("abcd")).collect())


def test_drift_report_statuses(spark):
    ref = spark.createDataFrame([(70.0 + i, 1, "x") for i in range(9)], "presence double, k int, t string")
    cur = spark.createDataFrame([(20.0 + i, None, "x") for i in range(8)], "presence double, k int, t string")
    feats = DR.drift_features(ref, cur, ["presence", "k", "gone"])
    got = {r["feature"]: r["status"] for r in feats.collect()}
    assert got == {"presence": "alert", "k": "missing", "gone": "missing"}
    assert DR.numeric_common(ref, cur) == ["presence", "k"]
    summary = DR.drift_summary(feats, ref, cur).first()
    assert (summary["status"], summary["alert_count"], summary["reference_rows"], summary["current_rows"]) == ("alert", 1, 9, 8)


# --- decisions --------------------------------------------------------------


def test_retraining_branches(spark):
    df = spark.sql(
        "SELECT 1 i, 'alert' drift_status, DATE '2024-09-01' trained_on, DATE '2024-10-01' as_of, false labels_available, false performance_alert "
        "UNION ALL SELECT 2, 'ok', DATE '2024-09-01', DATE '2025-09-02', true, false UNION ALL SELECT 3, 'watch', DATE '2024-09-01', DATE '2024-10-01', true, false "
        "UNION ALL SELECT 4, 'ok', DATE '2024-09-01', DATE '2024-10-01', true, true"
    )
    got = {r["i"]: (r["action"], r["reasons"]) for r in DC.retraining_decision(df).collect()}
    assert got == {
        1: ("investigate_and_collect_labels", ["data_drift_alert", "fresh_labels_unavailable"]),
        2: ("train_candidate", ["annual_review_due"]), 3: ("monitor", ["no_trigger"]),
        4: ("train_candidate", ["performance_alert"]),
    }


def test_promotion_branches(spark):
    df = spark.createDataFrame(
        [(1, 0.95, 0.96, 0.04, 0.95, False), (2, 0.95, 0.96, 0.04, 0.95, True), (3, 0.95, 0.92, 0.04, 0.96, True), (4, None, 0.9, 0.5, None, True), (5, 0.8, 0.5, 0.2, None, True)],
        "i int, auc_test double, recall_test double, fairness_recall_gap_test double, production_recall double, human_approved boolean",
    )
    got = {r["i"]: (r["approved_for_production"], r["reasons"]) for r in DC.promotion_decision(df).collect()}
    assert got == {
        1: (False, ["human_approval_required"]), 2: (True, []), 3: (False, ["recall_regression_vs_production"]),
        4: (False, ["missing_metrics:auc_test"]), 5: (False, ["auc_below_0.85", "recall_below_0.90", "fairness_gap_above_0.10"]),
    }


def test_alert_step_sequence(spark):
    df = spark.sql(
        "SELECT 1 i, 'alert' status, TIMESTAMP '2024-01-01 00:00:00' now, NULL::timestamp triggered_at, NULL::timestamp resolved_at "
        "UNION ALL SELECT 2, 'alert', TIMESTAMP '2024-01-01 01:00:00', TIMESTAMP '2024-01-01 00:00:00', NULL UNION ALL SELECT 3, 'ok', TIMESTAMP '2024-01-01 01:00:00', TIMESTAMP '2024-01-01 00:00:00', NULL "
        "UNION ALL SELECT 4, 'alert', TIMESTAMP '2024-01-02 00:00:00', TIMESTAMP '2024-01-01 00:00:00', NULL UNION ALL SELECT 5, 'watch', TIMESTAMP '2024-01-02 00:00:00', TIMESTAMP '2024-01-01 00:00:00', NULL"
    )
    got = {r["i"]: (r["should_alert"], r["should_resolve"]) for r in DC.alert_step(df).collect()}
    assert got == {1: (True, False), 2: (False, False), 3: (False, True), 4: (True, False), 5: (False, False)}


# --- splits and explanations ------------------------------------------------


def test_split_shares_and_repeatability(spark):
    df = spark.createDataFrame([(i, int(i % 10 < 3)) for i in range(1000)], "id int, y int")
    first = {r["id"]: r["split_set"] for r in S.assign_split(df.repartition(3), "y", "id").collect()}
    second = {r["id"]: r["split_set"] for r in S.assign_split(df.repartition(11), "y", "id").collect()}
    assert first == second
    counts = {(r["split_set"], r["y"]): r["n"] for r in S.split_counts(S.assign_split(df, "y", "id"), "y").collect()}
    assert counts == {("train", 0): 420, ("train", 1): 180, ("validation", 0): 140, ("validation", 1): 60, ("test", 0): 140, ("test", 1): 60}


def test_small_splits(spark):
    few = spark.createDataFrame([(i, int(i == 0)) for i in range(4)], "id int, y int")
    labels = {r["split_set"] for r in S.assign_split(few, "y", "id", allow_fallback=True).collect()}
    assert labels <= {"train", "validation", "test"} and "test" in labels
    one = spark.createDataFrame([(1, 1)], "id int, y int")
    with pytest.raises(ValueError):
        S.assign_split(one, "y", "id")
    assert [r["split_set"] for r in S.assign_split(one, "y", "id", allow_fallback=True).collect()] == ["train"]


def test_contributions_add_up(spark):
    df = spark.createDataFrame([(1.0, 2.0), (-3.0, 0.0)], "a double, b double")
    out = E.with_contributions(df, {"a": 0.5, "b": -2.0}, 0.25).collect()
    for r in out:
        assert 0.25 + sum(c["contribution"] for c in r["contributions"]) == pytest.approx(r["log_odds"], abs=1e-12)
    rows = E.factor_rows(E.with_contributions(df, {"a": 0.5, "b": -2.0}, 0.0), ["a"], 1).collect()
    assert {(r["a"], r["direction"], r["name"]) for r in rows} == {(1.0, "risk", "a"), (1.0, "protective", "b"), (-3.0, "protective", "a")}


def test_split_policy_has_no_caps(spark):
    singleton = spark.range(5000).select("id", F.when(F.col("id") == 7, -1).otherwise(F.col("id") % 1300).cast("int").alias("y"))
    assert S.split_policy(singleton, "y") == "shuffled"
    many = spark.range(12_000).select("id", (F.col("id") % 1200).cast("int").alias("y"))
    assert S.split_policy(many, "y") == "stratified"
    pairs = spark.range(2000).select("id", (F.col("id") % 1000).cast("int").alias("y"))
    assert S.split_policy(pairs, "y") == "refused"
    with pytest.raises(ValueError):
        S.assign_split(pairs, "y", "id")
    got = {r["split_set"]: r["n"] for r in S.assign_split(pairs, "y", "id", allow_fallback=True).groupBy("split_set").agg(F.count("id").alias("n")).collect()}
    assert got == {"test": 400, "validation": 400, "train": 1200}
    assert S.split_policy(spark.range(0).selectExpr("id", "1 AS y"), "y") == "refused"


def test_folds_hold_every_class(spark):
    rows = spark.range(1000).select("id", (F.col("id") < 5).cast("int").alias("y")).repartition(7)
    folds = S.stratified_folds(rows, "y", "id").groupBy("y", "fold").agg(F.count("id").alias("n")).collect()
    assert {(r["y"], r["fold"]): r["n"] for r in folds} == {(y, f): 199 if y == 0 else 1 for y in (0, 1) for f in range(5)}


def test_missing_scores_and_labels_do_not_count(spark):
    rows = [(1, 0.9), (0, 0.1), (1, float("nan")), (None, 0.9), (0, None)]
    got = M.threshold_curve(spark.createDataFrame(rows, "y int, s double"), "y", "s", thresholds=[0.5]).first()
    assert (got["tp"], got["fp"], got["fn"], got["tn"]) == (1, 0, 0, 1)


def test_unknown_reference_model(spark):
    table = spark.createDataFrame([("a", 0.9, 1.0), ("b", 0.8, 2.0)], "model string, auc double, cost double")
    assert M.cost_table(table, "model", "auc", "cost", "a").count() == 2
    with pytest.raises(ValueError):
        M.cost_table(table, "model", "auc", "cost", "c")


def test_empty_minutes_fire_on_request(spark):
    rows = [("a", m, m in (3, 9)) for m in (1, 3, 4, 9, 10)] + [("b", 5, True)]
    frame = spark.createDataFrame(rows, "k string, minute long, x boolean")
    got = {(r["k"], r["from_minute"], r["to_minute"]) for r in DC.pending_runs(frame, ["k"], "minute", "x", 2, no_data_fires=True).collect()}
    assert got == {("a", 2, 3), ("a", 5, 9)}


def test_each_table_is_read_once_for_both_directions(spark, tmp_path):
    spark.createDataFrame([(1, 1.0, 2.0)], "id int, a double, b double").write.parquet(str(tmp_path / "t"))
    frame = spark.read.parquet(str(tmp_path / "t"))
    plan = E.factor_rows(E.with_contributions(frame, {"a": 0.5, "b": -2.0}, 0.0), ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1


def events(spark, n=4000, seed=9):
    """Half of all events belong to one key, many share an instant, some have no key or no time."""
    rng = random.Random(seed)
    rows = [
        (i, "hot" if i % 2 else rng.choice(["a", "b", None, "c"]), None if i % 97 == 0 else rng.randrange(3000), rng.choice("fsx"))
        for i in range(n)
    ]
    frame = spark.createDataFrame(rows, "event_id long, k string, sec long, kind string")
    return rows, frame.withColumn("ts", F.timestamp_seconds("sec")).repartition(6)


def test_calls_in_window_split_a_hot_key(spark):
    rows, df = events(spark)
    out = RT.calls_in_window(df, ["k"], 60, 3)
    got = {r["event_id"]: (r["calls"], r["over_limit"]) for r in out.collect()}
    times = {}
    for _, k, t, _ in rows:
        if t is not None:
            times.setdefault(k, []).append(t)
    want = {i: sum(t - 60 < u <= t for u in times[k]) for i, k, t, _ in rows if t is not None}
    assert got == {i: (n, n > 3) for i, n in want.items()}
    assert out.columns == [*df.columns, "calls", "over_limit"]
    assert RT.calls_in_window(df.limit(0), ["k"], 60, 3).count() == 0


def test_failures_since_success_split_a_hot_key(spark):
    rows, df = events(spark)
    out = RT.failures_since_success(df, ["k"], F.col("kind") == "f", F.col("kind") == "s", 200, 3)
    got = {r["event_id"]: (r["failures"], r["locked"]) for r in out.collect()}
    want = {}
    for key in {r[1] for r in rows}:
        mine = sorted((t, i, kind) for i, k, t, kind in rows if k == key and t is not None)
        for x, (t, i, _) in enumerate(mine):
            n = 0
            for u, _, kind in mine[: x + 1]:
                n = 0 if kind == "s" else n + (kind == "f" and u > t - 200)
            want[i] = (n, n >= 3)
    assert got == want


def test_windows_are_not_dealt_by_key(spark):
    _, df = events(spark, 200)
    for out in (RT.calls_in_window(df, ["k"], 60, 3), RT.failures_since_success(df, ["k"], F.col("kind") == "f", F.col("kind") == "s", 60, 3)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(_id" in plan and "hashpartitioning(k" not in plan


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_lockouts_of_a_history_in_slices(spark, parts):
    rows, df = events(spark, 1500)
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        out = HI.lockouts(df, "k", F.col("kind") == "f", F.col("kind") == "s", 2, 300)
        got = {r["event_id"]: (r["key"], r["refused"], r["failures"]) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    want = {}
    for key in {r[1] for r in rows}:
        times = []
        for t, i, kind in sorted((t, i, kind) for i, k, t, kind in rows if k == key and t is not None):
            times = [u for u in times if u > t - 300]
            locked = len(times) >= 2
            if not locked:
                times = [*times, t] if kind == "f" else [] if kind == "s" else times
            want[i] = (key, locked, len(times))
    assert got == want
    assert HI.lockouts(df.limit(0), "k", F.col("kind") == "f", F.col("kind") == "s").count() == 0


def test_fold_hash_is_worked_out_before_the_sort(spark, monkeypatch):
    sorted_rows, kept = [], R.kept
    monkeypatch.setattr(R, "kept", lambda df: sorted_rows.append(df) or kept(df))
    S.stratified_folds(spark.range(50).select("id", (F.col("id") % 2).alias("y")), "y", "id")
    plan = sorted_rows[0]._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert any("Sort [" in line for line in plan) and not any("Sort [" in line and "md5" in line for line in plan)


def test_weighted_order_statistics(spark):
    rows = [("a", 1.5, 3), ("a", -2.0, 2), ("a", 9.0, 1), ("b", 4.0, 1), ("b", None, 5), ("c", None, 2)]
    df = spark.createDataFrame(rows, "g string, v double, w long")
    each = df.select("g", "v", F.explode(F.sequence(F.lit(1), F.col("w"))))
    want = R.order_statistics(each, ["g"], "v", R.median_picks()).collect()
    assert sorted(map(repr, R.order_statistics(df, ["g"], "v", R.median_picks(), weight="w").collect())) == sorted(map(repr, want))
