"""Experiment design and evaluation over session funnels and orders.

Row-level work (assignment, counting) is Spark aggregation; the statistics are column
arithmetic on the one-row or per-segment results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.columns import known, money_sum, or_zero, or_zero_money, ratio
from eventloom.functions.normal import quantile, upper_tail

CONTROL, TREATMENT = "control", "treatment"

# Fixed values of the published design: relative lifts, significance level, power.
LIFTS = (0.05, 0.10, 0.15)
ALPHA = 0.05
POWER = 0.80
CONFIDENCE = 0.95


# --- choosing and sizing ---------------------------------------------------------------


def _segment_totals(funnel: DataFrame, dimension: str) -> DataFrame:
    return (
        funnel.groupBy(known(dimension).alias("segment"))
        .agg(
            F.count_if("began_checkout").alias("checkout_sessions"),
            F.count_if("purchased").alias("purchase_sessions"),
            F.count_if(F.col("began_checkout") & F.col("purchased")).alias("converted_sessions"),
        )
        .select(
            "*",
            ratio("converted_sessions", "checkout_sessions").alias("checkout_to_purchase_rate"),
            ratio("purchase_sessions", "checkout_sessions").alias("purchases_per_checkout"),
        )
    )


def _calendar_days(funnel: DataFrame) -> Column:
    """Days from the first to the last session date, as a scalar."""
    return funnel.agg(F.date_diff(F.max("session_date"), F.min("session_date")) + 1).scalar()


def segment_conversion(funnel: DataFrame, dimension: str = "device_category") -> DataFrame:
    """Checkout-to-purchase conversion per segment, against the overall rate.

    The rate is the share of checkout sessions that purchased, as in every test and sample size
    here. `purchases_per_checkout` counts all purchase sessions, also those without a checkout.

    `is_target` marks the segment with the most checkout sessions, the lower rate deciding
    between equals. `is_lowest_rate` marks the lowest rate, so a target can be seen to be both.
    """
    segments = _segment_totals(funnel, dimension)
    rate = F.col("checkout_to_purchase_rate")
    # One row over the segments, so no window ranks all of them in one task.
    whole = segments.agg(
        F.struct(
            ratio(F.sum("converted_sessions"), F.sum("checkout_sessions")).alias("rate"),
            F.max(F.struct("checkout_sessions", -rate, "segment"))["segment"].alias("busiest"),
            F.min(rate).alias("lowest"),
        )
    ).scalar()
    return segments.select(
        "*",
        whole["rate"].alias("overall_rate"),
        (F.col("segment") == whole["busiest"]).alias("is_target"),
        F.coalesce(rate == whole["lowest"], F.lit(False)).alias("is_lowest_rate"),
    )


def target_segment(funnel: DataFrame, dimension: str = "device_category") -> Column:
    """The target of `segment_conversion`, as a scalar."""
    return segment_conversion(funnel, dimension).where("is_target").select("segment").scalar()


def eligible_traffic(funnel: DataFrame, dimension: str = "device_category") -> DataFrame:
    """Checkout sessions per segment and calendar day of the data's date range."""
    days = _calendar_days(funnel)
    return _segment_totals(funnel, dimension).select(
        "segment",
        F.col("checkout_sessions").alias("eligible_sessions"),
        days.alias("calendar_days"),
        ratio("checkout_sessions", days).alias("eligible_sessions_per_day"),
    )


def experiment_baselines(funnel: DataFrame, dimension: str = "device_category") -> DataFrame:
    """Input of `sample_size`: per segment its baseline rate and daily traffic."""
    return _segment_totals(funnel, dimension).select(
        "segment",
        F.col("checkout_to_purchase_rate").alias("baseline_rate"),
        ratio("checkout_sessions", _calendar_days(funnel)).alias("sessions_per_day"),
    )


def _effect_size(base: Column, lifted: Column) -> Column:
    """Cohen's h; NULL where the base converts nothing or the lift would push the rate over 1."""

    def angle(rate: Column) -> Column:
        return 2 * F.asin(F.sqrt(rate))

    return F.when((base > 0) & (lifted <= 1), angle(lifted) - angle(base))


def _sessions_per_variant(effect_size: Column, alpha: float, power: float) -> Column:
    """Closed form of the normal power equation, one-sided, equal allocation."""
    z = quantile(1 - alpha) + quantile(power)
    return F.ceil(2 * F.pow(F.lit(z) / effect_size, F.lit(2.0)))


def sample_size(
    baselines: DataFrame, lifts: Sequence[float] = LIFTS, alpha: float = ALPHA, power: float = POWER
) -> DataFrame:
    """Sessions and days needed per segment and relative lift."""
    base, lifted = F.col("baseline_rate"), F.col("treatment_rate")
    n = F.col("sample_size_per_variant")
    return (
        baselines.select(
            "segment", "baseline_rate", "sessions_per_day", F.explode(F.array(*map(F.lit, lifts))).alias("relative_lift")
        )
        .select("*", (base * (1 + F.col("relative_lift"))).alias("treatment_rate"))
        .select("*", _effect_size(base, lifted).alias("effect_size"))
        .select("*", _sessions_per_variant(F.col("effect_size"), alpha, power).alias("sample_size_per_variant"))
        .select(
            "segment",
            "relative_lift",
            "baseline_rate",
            "treatment_rate",
            (lifted - base).alias("absolute_lift"),
            "effect_size",
            "sample_size_per_variant",
            (n * 2).alias("total_sample_size"),
            F.ceil(ratio(n * 2, "sessions_per_day")).alias("estimated_days"),
        )
    )


# --- assignment and evaluation ---------------------------------------------------------


def assign_variants(
    df: DataFrame, unit: str = "user_pseudo_id", experiment: str = "checkout", treatment_share: float = 0.5
) -> DataFrame:
    """Add `variant`, a stable pseudo-random split of the unit.

    The first eight hex digits of an md5 are uniform and compare as text, so the split needs
    no state, survives retries, and can be repeated in any SQL engine. The limit has a ninth
    digit, so that shares of 0 and 1 give one variant only.
    """
    draw = F.concat(F.lit("0"), F.substring(F.md5(F.concat(F.lit(f"{experiment}:"), F.col(unit))), 1, 8))
    limit = f"{int((1 - treatment_share) * 16**8):09x}"
    return df.withColumn("variant", F.when(draw < limit, CONTROL).when(draw >= limit, TREATMENT))


def experiment_sessions(funnel: DataFrame, dimension: str = "device_category", **assignment) -> DataFrame:
    """The sessions of the target segment with their variants, in the columns that the evaluation reads."""
    mine = funnel.where(known(dimension) == target_segment(funnel, dimension))
    columns = ["session_id", "user_pseudo_id", "session_date", "began_checkout", "purchased", known(dimension).alias("segment")]
    return assign_variants(mine.select(*columns), **assignment)


def variant_counts(assigned: DataFrame, eligible: str = "began_checkout", success: str = "purchased") -> DataFrame:
    """One row: eligible sessions and conversions of both variants, rates and lifts.

    A conversion is an eligible session that also succeeded.
    """
    counts = []
    for variant in (CONTROL, TREATMENT):
        here = (F.col("variant") == variant) & F.col(eligible)
        counts += [
            F.count_if(here).alias(f"{variant}_sessions"),
            F.count_if(here & F.col(success)).alias(f"{variant}_conversions"),
        ]
    return with_rates(assigned.agg(*counts))


def with_rates(counts: DataFrame) -> DataFrame:
    """Add rates and lifts to a frame of per-variant sessions and conversions."""
    p_c, p_t = (ratio(f"{v}_conversions", f"{v}_sessions") for v in (CONTROL, TREATMENT))
    lift = F.col("treatment_rate") - F.col("control_rate")
    return counts.select("*", p_c.alias("control_rate"), p_t.alias("treatment_rate")).select(
        "*", lift.alias("absolute_lift"), ratio(lift, "control_rate").alias("relative_lift")
    )


def variant_summary(counts: DataFrame) -> DataFrame:
    """The same in long form: one row per variant, lifts against control."""
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(v).alias("variant"),
                        F.col(f"{v}_sessions").alias("sessions"),
                        F.col(f"{v}_conversions").alias("conversions"),
                        F.col(f"{v}_rate").alias("conversion_rate"),
                        (F.col(f"{v}_rate") - F.col("control_rate")).alias("absolute_lift"),
                        ratio(F.col(f"{v}_rate") - F.col("control_rate"), "control_rate").alias("relative_lift"),
                    )
                    for v in (CONTROL, TREATMENT)
                ]
            )
        )
    )


ALTERNATIVES = ("larger", "smaller", "two-sided")


def two_proportion_ztest(counts: DataFrame, alpha: float = ALPHA, alternative: str = "larger") -> DataFrame:
    """Pooled test that treatment converts better than control, worse, or differently.

    Sessions count as independent; where users are assigned, that holds as far as few users
    come back.
    """
    if alternative not in ALTERNATIVES:
        raise ValueError(f"alternative is one of {', '.join(ALTERNATIVES)}")
    n_c, n_t = F.col("control_sessions"), F.col("treatment_sessions")
    pooled = ratio(F.col("control_conversions") + F.col("treatment_conversions"), n_c + n_t)
    error = F.sqrt(F.col("pooled_rate") * (1 - F.col("pooled_rate")) * (ratio(F.lit(1), n_c) + ratio(F.lit(1), n_t)))
    z = ratio("absolute_lift", "standard_error")
    statistic = F.col("z_statistic")
    extreme = {"larger": statistic, "smaller": -statistic, "two-sided": F.abs(statistic)}[alternative]
    sides = 2 if alternative == "two-sided" else 1
    return (
        counts.select("*", pooled.alias("pooled_rate"))
        .select("*", error.alias("standard_error"))
        .select("*", z.alias("z_statistic"))
        .select(
            "*",
            (upper_tail(extreme) * sides).alias("p_value"),
            F.coalesce(extreme > quantile(1 - alpha / sides), F.lit(False)).alias("is_significant"),
        )
    )


def wald_difference(counts: DataFrame, confidence: float = CONFIDENCE) -> DataFrame:
    """Add the Wald interval of treatment rate minus control rate."""
    variance = F.lit(0.0)
    for v in (CONTROL, TREATMENT):
        rate = F.col(f"{v}_rate")
        variance = variance + ratio(rate * (1 - rate), f"{v}_sessions")
    margin = F.sqrt(variance) * quantile(0.5 + confidence / 2)
    return counts.select(
        "*",
        (F.col("absolute_lift") - margin).alias("difference_low"),
        (F.col("absolute_lift") + margin).alias("difference_high"),
    )


def user_sums(
    assigned: DataFrame, unit: str = "user_pseudo_id", eligible: str = "began_checkout", success: str = "purchased"
) -> DataFrame:
    """One row: for both variants the sums over units that the test of a ratio needs.

    n and x are a unit's eligible sessions and conversions; sums of whole numbers are exact, so
    they merge in any order. A unit with very many sessions is one row after the map-side combine.
    """
    per_unit = (
        assigned.where(F.col(unit).isNotNull() & F.col(eligible))
        .groupBy(unit)
        .agg(F.min("variant").alias("variant"), F.count("*").alias("n"), F.count_if(success).alias("x"))
    )
    sums = {"sessions": F.col("n"), "conversions": F.col("x"), "nn": F.col("n") * F.col("n"), "xx": F.col("x") * F.col("x"), "xn": F.col("x") * F.col("n")}
    totals = []
    for variant in (CONTROL, TREATMENT):
        here = F.col("variant") == variant
        totals.append(F.count_if(here).alias(f"{variant}_units"))
        totals += [or_zero(F.sum(F.when(here, value))).alias(f"{variant}_{name}") for name, value in sums.items()]
    return per_unit.agg(*totals)


def user_ratio_test(
    sums: DataFrame, alpha: float = ALPHA, alternative: str = "larger", confidence: float = CONFIDENCE
) -> DataFrame:
    """Test and interval of the difference in conversion where users, not sessions, are independent.

    The rate is a ratio of two sums over users, whose variance the delta method gives from what each
    user's conversions differ from the rate times their sessions. The test takes the common rate for both
    variants, the interval each variant's own. With one session a user both equal the tests of sessions;
    `design_effect` is how much larger the variance is than if sessions were independent.
    """
    if alternative not in ALTERNATIVES:
        raise ValueError(f"alternative is one of {', '.join(ALTERNATIVES)}")

    def both(name: str) -> Column:
        return F.col(f"{CONTROL}_{name}") + F.col(f"{TREATMENT}_{name}")

    def squares(xx: Column, xn: Column, nn: Column, rate: Column) -> Column:
        """Sum of (x - rate n)^2 over users."""
        return F.greatest(xx - 2 * rate * xn + rate * rate * nn, F.lit(0.0))

    pooled, statistic = F.col("pooled_rate"), F.col("z_statistic")
    spread = ratio(squares(both("xx"), both("xn"), both("nn"), pooled), both("units"))
    per_session = F.lit(0.0)
    own = F.lit(0.0)
    for v in (CONTROL, TREATMENT):
        n = F.col(f"{v}_sessions")
        per_session = per_session + ratio(F.col(f"{v}_units"), n.cast("double") * n)
        own = own + ratio(squares(*[F.col(f"{v}_{name}") for name in ("xx", "xn", "nn")], F.col(f"{v}_rate")), n.cast("double") * n)
    independent = pooled * (1 - pooled) * (ratio(F.lit(1), f"{CONTROL}_sessions") + ratio(F.lit(1), f"{TREATMENT}_sessions"))
    extreme = {"larger": statistic, "smaller": -statistic, "two-sided": F.abs(statistic)}[alternative]
    sides = 2 if alternative == "two-sided" else 1
    margin = F.sqrt(own) * quantile(0.5 + confidence / 2)
    counts = [f"{v}_{name}" for v in (CONTROL, TREATMENT) for name in ("units", "sessions", "conversions")]
    rates = ["control_rate", "treatment_rate", "absolute_lift", "relative_lift"]
    return (
        with_rates(sums)
        .select("*", ratio(both("conversions"), both("sessions")).alias("pooled_rate"))
        .select("*", F.sqrt(spread * per_session).alias("standard_error"))
        .select(
            "*",
            ratio("absolute_lift", "standard_error").alias("z_statistic"),
            ratio(F.col("standard_error") * F.col("standard_error"), independent).alias("design_effect"),
        )
        .select(
            *counts,
            *rates,
            "pooled_rate",
            "standard_error",
            "z_statistic",
            "design_effect",
            (upper_tail(extreme) * sides).alias("p_value"),
            F.coalesce(extreme > quantile(1 - alpha / sides), F.lit(False)).alias("is_significant"),
            (F.col("absolute_lift") - margin).alias("difference_low"),
            (F.col("absolute_lift") + margin).alias("difference_high"),
        )
    )


def modeled_impact(counts: DataFrame, order_value: Column | float) -> DataFrame:
    """Conversions beyond what control's rate gives on treatment's sessions, and their revenue."""
    extra = F.col("treatment_conversions") - F.col("treatment_sessions") * F.col("control_rate")
    value = F.lit(float(order_value)) if isinstance(order_value, (int, float)) else order_value
    # The order value may be a subquery, so it is named once.
    return counts.select("*", value.alias("average_order_value_usd")).select(
        "control_sessions",
        "control_conversions",
        "treatment_sessions",
        "treatment_conversions",
        "average_order_value_usd",
        extra.alias("incremental_conversions"),
        (extra * F.col("average_order_value_usd")).alias("incremental_revenue_usd"),
    )


def tested_segment(assigned: DataFrame) -> Column:
    """The segment of `experiment_sessions`, as a scalar."""
    return assigned.agg(F.min("segment")).scalar()


def average_order_value(segments: DataFrame, dimension: str, segment: Column | str) -> Column:
    """Revenue per order of one segment, as a scalar for `modeled_impact`."""
    mine = segments.where(F.col(dimension) == segment)
    return mine.agg(ratio(money_sum("revenue_usd"), F.sum("order_count"))).scalar()


# --- safety checks ---------------------------------------------------------------------


def guardrails(assigned: DataFrame, orders: DataFrame) -> DataFrame:
    """Per variant: order value, revenue per checkout, abandonment, purchase tracking quality.

    Orders are summed per session before the join, so a session with very many orders is one
    row there and orders without a session never enter it.
    """
    clean = ~F.col("has_duplicate_purchase_event") & ~F.col("has_missing_order_revenue")
    per_session = (
        orders.where(F.col("session_id").isNotNull())
        .groupBy("session_id")
        .agg(
            F.count("*").alias("orders"),
            money_sum("order_revenue_usd").alias("revenue"),
            F.count_if(clean).alias("clean_orders"),
        )
    )
    checkout = F.col("began_checkout")
    return (
        assigned.select("session_id", "variant", "began_checkout", "purchased")
        .join(per_session, "session_id", "left")
        .groupBy("variant")
        .agg(
            F.count("*").alias("total_sessions"),
            F.count_if(checkout).alias("checkout_sessions"),
            F.count_if(checkout & ~F.col("purchased")).alias("abandoned_checkouts"),
            or_zero(F.sum("orders")).alias("order_count"),
            or_zero_money(money_sum("revenue")).alias("revenue_usd"),
            or_zero(F.sum("clean_orders")).alias("clean_orders"),
        )
        .select(
            "variant",
            "total_sessions",
            "checkout_sessions",
            "order_count",
            "revenue_usd",
            ratio("revenue_usd", "order_count").alias("average_order_value_usd"),
            ratio("revenue_usd", "checkout_sessions").alias("revenue_per_checkout_usd"),
            ratio("abandoned_checkouts", "checkout_sessions").alias("checkout_abandonment_rate"),
            ratio("clean_orders", "order_count").alias("purchase_tracking_quality"),
        )
    )


def srm_check(
    assigned: DataFrame,
    unit: str = "user_pseudo_id",
    treatment_share: float = 0.5,
    alpha: float = ALPHA,
    eligible: str = "began_checkout",
) -> DataFrame:
    """Chi-square test (one degree of freedom) of the units in the test against the planned split.

    Units in the test are those with an eligible session.
    """
    total = F.col("control_units") + F.col("treatment_units")
    expected_t = total * F.lit(treatment_share)
    expected_c = total - expected_t
    chi2 = ratio(F.pow(F.col("control_units") - expected_c, F.lit(2.0)), expected_c) + ratio(
        F.pow(F.col("treatment_units") - expected_t, F.lit(2.0)), expected_t
    )
    # One degree of freedom: the critical value is the square of the two-sided normal one.
    critical = quantile(1 - alpha / 2) ** 2
    units = assigned.where(F.col(unit).isNotNull() & F.col(eligible)).groupBy(unit).agg(F.min("variant").alias("variant"))
    return (
        units.agg(
            F.count_if(F.col("variant") == CONTROL).alias("control_units"),
            F.count_if(F.col("variant") == TREATMENT).alias("treatment_units"),
        )
        .select(
            "*",
            expected_c.alias("expected_control_units"),
            expected_t.alias("expected_treatment_units"),
            chi2.alias("chi_square"),
        )
        .select("*", F.coalesce(F.col("chi_square") > critical, F.lit(False)).alias("has_sample_ratio_mismatch"))
    )


def rollout_decision(
    assigned: DataFrame,
    orders: DataFrame,
    relative_lift: float = 0.10,
    alpha: float = ALPHA,
    power: float = POWER,
    tolerated_loss: float = 0.05,
    minimum_tracking_quality: float = 0.60,
    minimum_days: int = 28,
) -> DataFrame:
    """One row: the five rollout conditions and whether all of them hold.

    Guardrails hold while treatment loses at most `tolerated_loss` of control's order value
    and revenue per checkout and does not raise abandonment by more than that; tracking is
    stable when both variants keep the minimum share of clean orders; runtime suffices when
    both variants reach the sample size for `relative_lift` over at least `minimum_days`.
    """
    test = two_proportion_ztest(variant_counts(assigned), alpha)
    guards = guardrails(assigned, orders)

    def of(variant: str, metric: str) -> Column:
        return F.max(F.when(F.col("variant") == variant, F.col(metric)))

    def kept(metric: str) -> Column:
        return of(TREATMENT, metric) >= of(CONTROL, metric) * (1 - tolerated_loss)

    guard = guards.agg(
        F.struct(
            (
                kept("average_order_value_usd")
                & kept("revenue_per_checkout_usd")
                & (
                    of(TREATMENT, "checkout_abandonment_rate")
                    <= of(CONTROL, "checkout_abandonment_rate") * (1 + tolerated_loss)
                )
            ).alias("acceptable"),
            (F.min("purchase_tracking_quality") >= minimum_tracking_quality).alias("stable"),
        )
    ).scalar()
    mismatch = srm_check(assigned, alpha=alpha).select("has_sample_ratio_mismatch").scalar()
    base = F.col("control_rate")
    required = _sessions_per_variant(_effect_size(base, base * (1 + relative_lift)), alpha, power)
    enough = (
        (F.least("control_sessions", "treatment_sessions") >= F.col("required_sessions_per_variant"))
        & (F.col("observed_days") >= minimum_days)
    )
    conditions = ["is_significant", "guardrails_acceptable", "no_sample_ratio_mismatch", "tracking_stable", "enough_runtime"]
    all_hold = F.lit(True)
    for condition in conditions:
        all_hold = all_hold & F.col(condition)
    return (
        test.select(
            "control_sessions",
            "treatment_sessions",
            "is_significant",
            F.coalesce(guard["acceptable"], F.lit(False)).alias("guardrails_acceptable"),
            (~mismatch).alias("no_sample_ratio_mismatch"),
            F.coalesce(guard["stable"], F.lit(False)).alias("tracking_stable"),
            _calendar_days(assigned).alias("observed_days"),
            required.alias("required_sessions_per_variant"),
        )
        .select("*", F.coalesce(enough, F.lit(False)).alias("enough_runtime"))
        .select("*", all_hold.alias("roll_out"))
    )
