"""Currency conversion to the reporting currency.

The rate table holds one row per currency code and is broadcast: a join dealt by
currency would put a third of all documents into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from billframe.config import DEFAULT_SETTINGS, TARGET_CURRENCY, Settings
from billframe.functions.money import MONEY_TYPE, RATE_TYPE


def fx_table(spark: SparkSession, settings: Settings = DEFAULT_SETTINGS) -> DataFrame:
    """(currency, fx_rate decimal(18,8), fx_as_of date) from settings."""
    rows = [(code, str(rate)) for code, rate in settings.rate_items()]
    return spark.createDataFrame(rows, "currency string, rate string").select(
        F.upper(F.trim("currency")).alias("fx_currency"),
        F.col("rate").cast(RATE_TYPE).alias("fx_rate"),
        F.lit(settings.fx_as_of).cast("date").alias("fx_as_of"),
    )


def attach_rates(df: DataFrame, currency_col: str, rates: DataFrame) -> DataFrame:
    """Left-join the rate for the upper-trimmed code; non-positive rates are absent.

    The rate table has a row for each currency, some hundred at most, whatever the number of documents.
    """
    valid = rates.where(F.col("fx_rate") > 0)
    return df.join(F.broadcast(valid), F.upper(F.trim(F.col(currency_col))) == F.col("fx_currency"), "left").drop("fx_currency")


def to_gbp(amount: Column, rate: Column) -> Column:
    """Amount / rate rounded half-up (away from zero) to 2 decimals.

    decimal(28,8) / decimal(18,8) keeps 10 fractional digits before the
    final rounding (see README for the residual double-rounding bound).
    """
    return F.round(amount.cast(MONEY_TYPE) / rate.cast(RATE_TYPE), 2).cast(MONEY_TYPE)


def convert(amount: Column, currency: Column, rate: Column) -> Column:
    """Convert only when the source currency is not the reporting one."""
    return F.when(currency == F.lit(TARGET_CURRENCY), amount).otherwise(to_gbp(amount, rate))


def is_reversible(originals: list[Column], stored: list[Column], rate: Column, tolerance: str = "0.01") -> Column:
    """E5: every stored amount reproduces from its original within the tolerance."""
    checks = [F.abs(to_gbp(o, rate) - s) <= F.lit(tolerance).cast("decimal(4,2)") for o, s in zip(originals, stored)]
    out = checks[0]
    for c in checks[1:]:
        out = out & c
    return out
