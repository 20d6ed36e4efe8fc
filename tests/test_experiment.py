"""Experiment arithmetic against the published figures, and the safety checks."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.functions.normal import upper_tail
from eventloom.operators import experiment as x
from tests.conftest import by, only

ORDER_VALUE = 69.86609240407


@pytest.fixture(scope="module")
def published(spark):
    """1157 sessions per variant, 610 and 684 conversions."""
    counts = spark.createDataFrame(
        [(1157, 610, 1157, 684)],
        "control_sessions long, control_conversions long, treatment_sessions long, treatment_conversions long",
    )
    return x.with_rates(counts)


def test_published_sample_sizes(spark):
    baseline = spark.createDataFrame(
        [("desktop", 1601 / 3109, 3109 / 92)], "segment string, baseline_rate double, sessions_per_day double"
    )
    rows = by(x.sample_size(baseline), "relative_lift")
    assert {
        lift: (r.sample_size_per_variant, r.total_sample_size, r.estimated_days) for lift, r in rows.items()
    } == {0.05: (4648, 9296, 276), 0.10: (1157, 2314, 69), 0.15: (512, 1024, 31)}


def test_impossible_lift_has_no_size(spark):
    baseline = spark.createDataFrame(
        [("a", 0.99, 1.0), ("b", 0.0, 1.0), ("c", None, 1.0)], "segment string, baseline_rate double, sessions_per_day double"
    )
    rows = x.sample_size(baseline, [0.05]).collect()
    assert [(r.sample_size_per_variant, r.estimated_days) for r in rows] == [(None, None)] * 3


def test_published_test_and_interval(published):
    row = only(x.wald_difference(x.two_proportion_ztest(published)))
    assert round(row.control_rate, 4) == 0.5272 and round(row.treatment_rate, 4) == 0.5912
    assert round(row.absolute_lift, 4) == 0.0640 and round(row.relative_lift, 4) == 0.1213
    assert round(row.z_statistic, 3) == 3.098 and round(row.p_value, 4) == 0.0010 and row.is_significant
    assert (round(row.difference_low, 4), round(row.difference_high, 4)) == (0.0236, 0.1043)


def test_published_impact(published):
    row = only(x.modeled_impact(published, ORDER_VALUE))
    assert round(row.incremental_conversions) == 74 and round(row.incremental_revenue_usd, 2) == 5170.09


def test_summary_is_the_long_form(published):
    rows = by(x.variant_summary(published), "variant")
    assert rows["control"].absolute_lift == 0.0 and rows["treatment"].conversions == 684
    assert rows["treatment"].relative_lift == pytest.approx(74 / 610)


def test_upper_tail(spark):
    df = spark.createDataFrame([(0.0,), (1.6448536269514722,), (-3.0,), (None,)], "z double")
    tails = [r.p for r in df.select(upper_tail(F.col("z")).alias("p")).collect()]
    assert tails[:2] == pytest.approx([0.5, 0.05]) and tails[2] == pytest.approx(0.99865, abs=1e-5)
    assert tails[3] is None or math.isnan(tails[3])


FUNNEL = (
    "session_id string, user_pseudo_id string, session_date date, device_category string,"
    " began_checkout boolean, purchased boolean"
)


def funnel(spark, rows):
    return spark.createDataFrame(rows, "session_id string, user_pseudo_id string, day int, device_category string, began_checkout boolean, purchased boolean").select(
        "session_id",
        "user_pseudo_id",
        F.date_add(F.lit("2024-03-04").cast("date"), F.col("day")).alias("session_date"),
        "device_category",
        "began_checkout",
        "purchased",
    )


def test_target_segment_and_traffic(spark):
    rows = [(f"d{i}", "u", i % 10, "desktop", True, i % 2 == 0) for i in range(20)]
    rows += [(f"m{i}", "u", 0, "mobile", i < 4, i < 4) for i in range(9)]
    rows += [("n", "u", 0, None, False, False)]
    df = funnel(spark, rows)
    found = by(x.segment_conversion(df), "segment")
    assert (found["desktop"].checkout_sessions, found["desktop"].checkout_to_purchase_rate) == (20, 0.5)
    assert found["desktop"].is_target and found["desktop"].is_lowest_rate and not found["mobile"].is_target
    assert found["desktop"].overall_rate == pytest.approx(14 / 24)
    assert found["Unknown"].checkout_to_purchase_rate is None and not found["Unknown"].is_lowest_rate
    traffic = by(x.eligible_traffic(df), "segment")
    assert (traffic["desktop"].calendar_days, traffic["desktop"].eligible_sessions_per_day) == (10, 2.0)
    assert by(x.experiment_baselines(df), "segment")["desktop"].baseline_rate == 0.5


def test_the_extreme_shares_give_one_variant(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("user_pseudo_id"))
    for share, only_one in ((0.0, "control"), (1.0, "treatment")):
        assert [r.variant for r in x.assign_variants(df, treatment_share=share).select("variant").distinct().collect()] == [only_one]


def test_alternatives(published):
    p = {a: only(x.two_proportion_ztest(published, alternative=a)).p_value for a in x.ALTERNATIVES}
    assert p["larger"] + p["smaller"] == pytest.approx(1) and p["two-sided"] == pytest.approx(2 * p["larger"])
    assert not only(x.two_proportion_ztest(published, alternative="smaller")).is_significant
    with pytest.raises(ValueError):
        x.two_proportion_ztest(published, alternative="other")


def test_a_purchase_without_checkout_is_no_conversion(spark):
    rows = [(f"d{i}", "u", i % 10, "desktop", i < 20, i % 2 == 0) for i in range(30)]
    row = only(x.segment_conversion(funnel(spark, rows)))
    assert (row.purchase_sessions, row.converted_sessions, row.checkout_to_purchase_rate) == (15, 10, 0.5)
    assert row.purchases_per_checkout == 0.75


def test_planning_and_decision_need_the_same_number(spark):
    df = assigned(spark, 400, 400)
    orders = spark.createDataFrame([], "session_id string, order_revenue_usd double, has_duplicate_purchase_event boolean, has_missing_order_revenue boolean")
    planned = only(x.sample_size(x.experiment_baselines(df), [0.10])).sample_size_per_variant
    assert only(x.rollout_decision(df, orders, relative_lift=0.10)).required_sessions_per_variant == planned


def test_sample_ratio_counts_the_units_in_the_test(spark):
    df = assigned(spark, 100, 100).unionByName(
        assigned(spark, 300, 0).withColumn("began_checkout", F.lit(False)).withColumn("user_pseudo_id", F.concat(F.lit("x"), "user_pseudo_id"))
    )
    row = only(x.srm_check(df))
    assert (row.control_units, row.treatment_units) == (100, 100)


def test_assignment_is_stable_and_even(spark):
    df = spark.range(20_000).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("user_pseudo_id"))
    once = x.assign_variants(df)
    assert once.exceptAll(x.assign_variants(df.repartition(7))).isEmpty()
    share = once.where("variant = 'treatment'").count() / 20_000
    assert abs(share - 0.5) < 0.02
    tenth = x.assign_variants(df, treatment_share=0.1).where("variant = 'treatment'").count() / 20_000
    assert abs(tenth - 0.1) < 0.02
    assert x.assign_variants(df, experiment="other").exceptAll(once).count() > 0


def assigned(spark, control, treatment, rate_c=0.5, rate_t=0.5, days=30):
    rows = []
    for variant, n, rate in (("control", control, rate_c), ("treatment", treatment, rate_t)):
        rows += [(f"{variant}{i}", f"{variant}{i}", i % days, "desktop", True, i < n * rate, variant) for i in range(n)]
    base = spark.createDataFrame(
        rows,
        "session_id string, user_pseudo_id string, day int, device_category string, began_checkout boolean,"
        " purchased boolean, variant string",
    )
    return base.withColumn("session_date", F.date_add(F.lit("2024-03-04").cast("date"), F.col("day")))


def placed(spark, sessions, revenue=10.0, repeated=False):
    return sessions.where("purchased").select(
        "session_id",
        F.lit(revenue).alias("order_revenue_usd"),
        F.lit(repeated).alias("has_duplicate_purchase_event"),
        F.lit(False).alias("has_missing_order_revenue"),
    )


def test_guardrails(spark):
    df = assigned(spark, 10, 20, 0.5, 0.25)
    extra = spark.createDataFrame([(None, 99.0, False, False), ("elsewhere", 99.0, False, False), ("control0", 30.0, True, False)], placed(spark, df).schema)
    rows = by(x.guardrails(df, placed(spark, df).unionByName(extra)), "variant")
    c, t = rows["control"], rows["treatment"]
    assert (c.order_count, c.revenue_usd, c.average_order_value_usd, c.revenue_per_checkout_usd) == (6, 80.0, 80 / 6, 8.0)
    assert (c.checkout_abandonment_rate, t.checkout_abandonment_rate) == (0.5, 0.75)
    assert (c.purchase_tracking_quality, t.purchase_tracking_quality) == (5 / 6, 1.0)


@pytest.mark.parametrize(("control", "treatment", "mismatch"), [(100, 100, False), (100, 130, True), (100, 127, False)])
def test_sample_ratio(spark, control, treatment, mismatch):
    row = only(x.srm_check(assigned(spark, control, treatment)))
    assert row.chi_square == pytest.approx((control - treatment) ** 2 / (control + treatment))
    assert row.has_sample_ratio_mismatch is mismatch


def test_rollout_needs_every_condition(spark):
    good = assigned(spark, 1300, 1300, 0.5, 0.6)
    row = only(x.rollout_decision(good, placed(spark, good)))
    assert row.roll_out and row.observed_days == 30 and row.required_sessions_per_variant < 1300

    def failing(df, orders):
        row = only(x.rollout_decision(df, orders))
        assert not row.roll_out
        names = ["is_significant", "guardrails_acceptable", "no_sample_ratio_mismatch", "tracking_stable", "enough_runtime"]
        return [n for n in names if not row[n]]

    short = assigned(spark, 1300, 1300, 0.5, 0.6, days=5)
    assert failing(short, placed(spark, short)) == ["enough_runtime"]
    same = assigned(spark, 1300, 1300)
    assert failing(same, placed(spark, same)) == ["is_significant"]
    skewed = assigned(spark, 1500, 1300, 0.5, 0.6)
    assert failing(skewed, placed(spark, skewed)) == ["no_sample_ratio_mismatch"]
    assert failing(good, placed(spark, good, repeated=True)) == ["tracking_stable"]
    cheap = placed(spark, good.where("variant = 'control'")).unionByName(
        placed(spark, good.where("variant = 'treatment'"), revenue=1.0)
    )
    assert failing(good, cheap) == ["guardrails_acceptable"]


def assigned_of(spark, rows):
    """rows: user, variant, began_checkout, purchased."""
    return spark.createDataFrame(rows, "user_pseudo_id string, variant string, began_checkout boolean, purchased boolean")


def test_users_with_one_session_give_the_plain_test(spark):
    rng = random.Random(1)
    rows = [(f"u{i}", rng.choice(["control", "treatment"]), i % 9 > 0, rng.random() < 0.4) for i in range(500)]
    assigned = assigned_of(spark, rows)
    plain = only(x.wald_difference(x.two_proportion_ztest(x.variant_counts(assigned))))
    found = only(x.user_ratio_test(x.user_sums(assigned)))
    for name in ("control_sessions", "treatment_conversions", "pooled_rate", "standard_error", "z_statistic", "p_value", "difference_low", "difference_high"):
        assert found[name] == pytest.approx(plain[name], abs=1e-9), name
    assert found.design_effect == pytest.approx(1) and found.control_units == found.control_sessions


def clustered(rng, users=300):
    """Users of one to nine sessions, who convert in most of theirs or in few."""
    rows = []
    for i in range(users):
        variant, rate = rng.choice(["control", "treatment"]), rng.choice([0.05, 0.9])
        rows += [(f"u{i}", variant, True, rng.random() < rate) for _ in range(rng.randint(1, 9))]
    return rows


def test_user_variance_equals_the_bootstrap(spark):
    rows = clustered(random.Random(3))
    found = only(x.user_ratio_test(x.user_sums(assigned_of(spark, rows))))
    plain = only(x.two_proportion_ztest(x.variant_counts(assigned_of(spark, rows))))
    sums = {}
    for user, variant, _, bought in rows:
        n, k = sums.get((variant, user), (0, 0))
        sums[variant, user] = n + 1, k + bought
    by_variant = {v: np.array([s for (w, _), s in sums.items() if w == v], float) for v in ("control", "treatment")}
    rng = np.random.default_rng(5)
    drawn = {}
    for v, own in by_variant.items():
        picks = rng.integers(0, len(own), (4000, len(own)))
        n, k = own[picks].sum(axis=1).T
        drawn[v] = k / n
    difference = drawn["treatment"] - drawn["control"]
    width = (found.difference_high - found.difference_low) / 2 / 1.959964
    assert width == pytest.approx(difference.std(), rel=0.06)
    # Counting sessions as independent would claim too much.
    assert found.design_effect > 2 and found.standard_error > 1.4 * plain.standard_error
    assert found.absolute_lift == pytest.approx(plain.absolute_lift)


def test_user_test_of_nothing_and_of_directions(spark):
    empty = only(x.user_ratio_test(x.user_sums(assigned_of(spark, []))))
    assert (empty.control_sessions, empty.z_statistic, empty.is_significant) == (0, None, False)
    sums = x.user_sums(assigned_of(spark, [*clustered(random.Random(4)), (None, "control", True, True), ("z", "control", False, True)]))
    p = {a: only(x.user_ratio_test(sums, alternative=a)).p_value for a in x.ALTERNATIVES}
    assert p["larger"] + p["smaller"] == pytest.approx(1) and p["two-sided"] == pytest.approx(2 * min(p["larger"], p["smaller"]))
    with pytest.raises(ValueError):
        x.user_ratio_test(sums, alternative="other")
