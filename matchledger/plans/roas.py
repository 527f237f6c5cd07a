"""Return on ad spend by install cohort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchledger.functions import cohort_label, days_between, or_zero, ratio_or_null, round3
from matchledger.functions.scalars import COHORT_BANDS
from matchledger.operators.spine import last_date
from matchledger.operators.windows import running_frame
from matchledger.schemas import COHORT_KEYS, ROAS

SOURCE_KEYS = ["media_source", "install_country"]


def latest_days(daily: DataFrame, latest: Column | None = None) -> DataFrame:
    """Player-days from the latest date on. Pass `latest` when it is known."""
    latest = last_date(daily) if latest is None else latest
    return daily.filter(F.col("date_utc") >= latest)


def latest_revenue(daily: DataFrame, installs: DataFrame, latest: Column | None = None) -> DataFrame:
    """Installs with their player's revenue on the latest date.

    The written outer join keeps only rows with a date, so it is an inner one.
    """
    days = latest_days(daily, latest).select("player_id", "date_utc", "revenue")
    return installs.join(days, "player_id").select(
        "player_id", "date_utc", "install_date", *SOURCE_KEYS, "revenue"
    )


def cumulative_revenue(daily: DataFrame, installs: DataFrame, latest: Column | None = None) -> DataFrame:
    """Running revenue of each player over the days that passed the filter: the latest one."""
    so_far = F.sum("revenue").over(running_frame(["player_id"], "date_utc"))
    return latest_revenue(daily, installs, latest).select(
        "player_id", "date_utc", "install_date", *SOURCE_KEYS,
        or_zero(so_far).alias("cumulative_revenue"),
    )


def days_since_install(daily: DataFrame, installs: DataFrame, latest: Column | None = None) -> DataFrame:
    return cumulative_revenue(daily, installs, latest).select(
        "player_id", *SOURCE_KEYS, "install_date",
        days_between("install_date", "date_utc").alias("days_since_install"),
        "cumulative_revenue",
    )


def within_90_days(ages: DataFrame) -> DataFrame:
    return ages.filter(F.col("days_since_install") <= COHORT_BANDS[-1][1])


def spend_totals(spend: DataFrame) -> DataFrame:
    return spend.groupBy("media_source", F.col("country").alias("install_country")).agg(
        F.sum("spend").alias("total_spend")
    )


def with_spend(cohorts: DataFrame, spend: DataFrame) -> DataFrame:
    """Left join to the spend per source and country.

    No broadcast is asked for: the planner broadcasts the totals when their
    measured size allows it, and splits a hot source otherwise.
    """
    return cohorts.join(spend_totals(spend), SOURCE_KEYS, "left")


def cohort_revenue(
    daily: DataFrame, installs: DataFrame, spend: DataFrame, latest: Column | None = None
) -> DataFrame:
    """Revenue per cohort and band with the spend of its source.

    Players are summed up before the join, since the spend is one number per
    source and country; the join then sees one row per cohort.
    """
    cohorts = (
        within_90_days(days_since_install(daily, installs, latest))
        .groupBy(*SOURCE_KEYS, "install_date", cohort_label("days_since_install").alias("cohort_period"))
        .agg(F.sum("cumulative_revenue").alias("cohort_revenue"))
    )
    return with_spend(cohorts, spend).select(*COHORT_KEYS, "cohort_revenue", "total_spend")


def with_ratio(cohorts: DataFrame) -> DataFrame:
    """No spend, or a spend of zero, gives NULL."""
    ratio = round3(ratio_or_null("cohort_revenue", "total_spend"))
    return cohorts.select(*COHORT_KEYS, ratio.alias("roas"))


def marketing_roas(
    daily: DataFrame, installs: DataFrame, spend: DataFrame, latest: Column | None = None
) -> DataFrame:
    """The fact as written: the revenue of the latest day, in disjoint age bands."""
    return with_ratio(cohort_revenue(daily, installs, spend, latest)).select(*ROAS.columns)


def roas_cumulative(daily: DataFrame, installs: DataFrame, spend: DataFrame) -> DataFrame:
    """Revenue from the install through day 7, 14, 30 and 90, in nested periods.

    Every install counts, with no revenue if the player has no days. Days
    before the install are not part of any period.
    """
    age = days_between("install_date", "date_utc")
    days = daily.select("player_id", "date_utc", "revenue").filter(F.col("revenue") != 0)
    per_cohort = (
        installs.join(days, "player_id", "left")
        .groupBy(*SOURCE_KEYS, "install_date")
        .agg(
            *[
                or_zero(F.sum(F.when((age >= 0) & (age <= upper), F.col("revenue")))).alias(name)
                for name, upper in COHORT_BANDS
            ]
        )
    )
    periods = per_cohort.unpivot(
        [*SOURCE_KEYS, "install_date"], [name for name, _ in COHORT_BANDS], "cohort_period", "cohort_revenue"
    )
    return with_ratio(with_spend(periods, spend)).select(*ROAS.columns)
