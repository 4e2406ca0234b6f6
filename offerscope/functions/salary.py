"""Salary text and structured salaries -> yearly bounds or a daily rate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from offerscope.functions.text import blank_to_null, first_match, norm, rx
from offerscope.vocab import salary as V


def _guessed_period(amount: Column) -> Column:
    chain = F.when(F.lit(False), F.lit(None).cast("string"))
    for period, floor in V.PERIOD_FLOORS:
        chain = chain.when(amount >= floor, F.lit(period))
    return chain.when(amount.isNotNull(), F.lit("hour"))


def _periods_per_year(period: Column, hours: int) -> Column:
    chain = F.when(period == "hour", F.lit(float(hours)))
    for name, factor in V.PERIODS_PER_YEAR.items():
        chain = chain.when(period == name, F.lit(factor))
    return chain


def _amount(token: Column) -> Column:
    digits = F.replace(token, F.lit(" "), F.lit(""))
    plain = F.when(digits.rlike(V.DOTTED_THOUSANDS), F.replace(digits, F.lit("."), F.lit(""))) \
             .otherwise(F.replace(digits, F.lit(","), F.lit(".")))
    return plain.try_cast("double")


def with_salary(df: DataFrame, text: str = "salary_raw", minimum: str = "salary_min_raw",
                maximum: str = "salary_max_raw", unit: str = "salary_unit_raw",
                hours_per_year: int = 1607) -> DataFrame:
    """Adds ``salary_min, salary_max, salary_mid, daily_rate, salary_period``.

    Structured bounds win over the text. A daily rate is kept apart and never annualised.
    """
    lo, hi = F.col(minimum), F.col(maximum)
    structured = lo.isNotNull() | hi.isNotNull()

    # Text: drop the fragments that are not amounts, then read the period and the numbers.
    clean = norm(F.col(text))
    for pattern in V.NOT_AMOUNTS:
        clean = F.regexp_replace(clean, rx(pattern), " ")
    df = df.withColumn("_pay", F.when(~structured, clean))
    df = df.select(
        "*",
        first_match(F.col("_pay"), V.PERIOD_RULES).alias("_said"),
        F.transform(F.regexp_extract_all("_pay", F.lit(rx(V.AMOUNT)), F.lit(1)), _amount).alias("_amounts"),
        F.exists(F.regexp_extract_all("_pay", F.lit(rx(V.AMOUNT)), F.lit(2)), lambda k: k != "").alias("_kilo"),
    )
    in_thousands = F.col("_kilo") | ((F.col("_said") == "year") & (F.array_max("_amounts") < 1000))
    scaled = F.when(
        F.coalesce(in_thousands, F.lit(False)),
        F.transform("_amounts", lambda v: F.when(v < 1000, v * 1000).otherwise(v)),
    ).otherwise(F.col("_amounts"))
    df = df.withColumn("_scaled", scaled)

    df = df.withColumn("_unit", norm(blank_to_null(F.col(unit))))
    named = F.when(F.lit(False), F.lit(None).cast("string"))
    for alias, period in V.UNIT_ALIASES.items():
        named = named.when(F.col("_unit") == alias, F.lit(period))
    df = df.select(
        "*",
        F.when(structured, F.least(lo, hi)).otherwise(F.array_min("_scaled")).alias("_lo"),
        F.when(structured, F.greatest(lo, hi)).otherwise(F.array_max("_scaled")).alias("_hi"),
        F.when(structured, named).otherwise(F.col("_said")).alias("_named"),
    )
    df = df.withColumn("salary_period",
                       F.when(F.col("_hi").isNotNull(), F.coalesce("_named", _guessed_period(F.col("_hi")))))
    daily = F.col("salary_period") == "day"
    factor = _periods_per_year(F.col("salary_period"), hours_per_year)
    df = df.withColumns({
        "daily_rate": F.when(daily, (F.col("_lo") + F.col("_hi")) / 2),
        "salary_min": F.when(~daily, F.col("_lo") * factor),
        "salary_max": F.when(~daily, F.col("_hi") * factor),
    })
    df = df.withColumn("salary_mid", (F.col("salary_min") + F.col("salary_max")) / 2)
    return df.drop("_pay", "_said", "_amounts", "_kilo", "_scaled", "_unit", "_lo", "_hi", "_named")


def plausible(df: DataFrame, keep: Column, columns: tuple[str, ...] = ("salary_min", "salary_max", "salary_mid"),
              ) -> DataFrame:
    """Nulls the salary columns where ``keep`` does not hold; the row stays."""
    return df.withColumns({c: F.when(keep, F.col(c)) for c in columns})
