"""Figures derived from an account's own columns.

Amounts stay exact decimals and are cast explicitly per column; elapsed days are
doubles. ``as_of`` is an argument: the current time would make no run repeatable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.cells import elapsed_days

MONEY = "decimal(18,8)"


def hour_price(recurring: Column, days: Column, current: Column) -> Column:
    """Recurring amount per hour where no price is set; no division by zero."""
    usable = days.isNotNull() & (days != 0) & current.isNull()
    return F.when(usable, (recurring.cast(MONEY) / days / 24).cast(MONEY)).otherwise(current)


def expected_paid(
    upfront: Column, hourly: Column, days: Column, days_included: Column, unlock: Column
) -> Column:
    """What is due so far, at most the unlock price. Nulls are skipped by least/greatest."""
    paid_days = F.greatest(days.cast(MONEY) - days_included, F.lit(0).cast(MONEY))
    return F.least((upfront + (hourly * 24) * paid_days).cast(MONEY), unlock)


def amount_in_arrears(expected: Column, paid: Column) -> Column:
    return F.greatest(F.lit(0).cast(MONEY), (expected - paid).cast(MONEY))


def days_disabled(linked: Column, days: Column, activated: Column) -> Column:
    """0 for an account linked to another one."""
    idle = F.greatest(days - activated.cast("double"), F.lit(0.0))
    return F.when(linked.isNull(), idle).otherwise(F.lit(0.0))


def _kept(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def account_figures(df: DataFrame, as_of: Column, disabled_for: str) -> DataFrame:
    """All derived figures of an account, each reading the ones before it."""
    df = df.withColumns(
        {
            "hour_price": hour_price(
                F.col("recurring_amount"),
                F.col("days_per_recurring_amount"),
                _kept(df, "hour_price", MONEY),
            ),
            "days_since_registration": elapsed_days(as_of, F.col("registration_date_utc")),
            "days_to_cutoff": elapsed_days(F.col("date_of_disablement_utc"), as_of),
            "outstanding_amount": (F.col("unlock_price") - F.col("total_paid")).cast(MONEY),
        }
    )
    df = df.withColumns(
        {
            "expected_paid": F.when(
                F.col("hour_price") > 0,
                expected_paid(
                    F.col("upfront_price"),
                    F.col("hour_price"),
                    F.col("days_since_registration"),
                    F.col("upfront_days_included"),
                    F.col("unlock_price"),
                ),
            ).otherwise(_kept(df, "expected_paid", MONEY)),
            "cumulative_days_disabled": F.when(
                F.col("external_sys") == disabled_for,
                days_disabled(
                    F.col("linked_account_external_id"),
                    F.col("days_since_registration"),
                    F.col("cumulative_activation_days"),
                ),
            ).otherwise(_kept(df, "cumulative_days_disabled", "double")),
        }
    )
    return df.withColumn(
        "amount_in_arrears", amount_in_arrears(F.col("expected_paid"), F.col("total_paid"))
    )


def set_where(df: DataFrame, when: Column, **values: Column | None) -> DataFrame:
    """Overwrite columns on the rows that pass ``when``; None clears them."""
    out = {}
    for name, value in values.items():
        kind = df.schema[name].dataType
        new = F.lit(None).cast(kind) if value is None else value.cast(kind)
        out[name] = F.when(when, new).otherwise(F.col(name))
    return df.withColumns(out)
