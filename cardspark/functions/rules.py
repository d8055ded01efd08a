"""Business rules as reusable Column expressions.

Each function returns a JVM-side Column, so every rule stays inside
whole-stage codegen wherever it is used.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# Fixed values that must equal the reference's: band labels and their edges.
# credit score: < 580 Poor, <= 669 Fair, <= 739 Good, <= 799 Very Good, else Excellent
# age: < 25 '<25', <= 34 '25-34', <= 44 '35-44', <= 54 '45-54', <= 64 '55-64', else '65+'
# yearly income: < 30000 '<30k', <= 60000 '30-60k', <= 100000 '60-100k', else '100k+'
# credit limit: = 0 '0', < 5000 '<5k', <= 15000 '5-15k', <= 30000 '15-30k', else '30k+'
CREDIT_BANDS = ["Poor", "Fair", "Good", "Very Good", "Excellent"]


def valid_spend(errors="errors", amount="amount") -> Column:
    """Valid spend: a successful transaction (NULL error) with a positive amount."""
    return _c(errors).isNull() & (_c(amount) > 0)


def credit_band(score="credit_score") -> Column:
    s = _c(score)
    return (F.when(s < 580, "Poor").when(s <= 669, "Fair").when(s <= 739, "Good")
            .when(s <= 799, "Very Good").otherwise("Excellent"))


def credit_band_order(score="credit_score") -> Column:
    s = _c(score)
    return (F.when(s < 580, 1).when(s <= 669, 2).when(s <= 739, 3)
            .when(s <= 799, 4).otherwise(5))


def credit_band_draft(score="credit_score") -> Column:
    """First draft of the bands, with strict upper bounds.

    669, 739 and 799 (and NULL) fall through to 'Excellent'. Kept as a
    regression example of the off-by-one the corrected bands fix.
    """
    s = _c(score)
    return (F.when(s < 580, "Poor")
            .when((s >= 580) & (s < 669), "Fair")
            .when((s >= 670) & (s < 739), "Good")
            .when((s >= 740) & (s < 799), "Very Good")
            .otherwise("Excellent"))


def age_group(age="current_age") -> Column:
    a = _c(age)
    return (F.when(a < 25, "<25").when(a <= 34, "25-34").when(a <= 44, "35-44")
            .when(a <= 54, "45-54").when(a <= 64, "55-64").otherwise("65+"))


def income_band(income="yearly_income") -> Column:
    i = _c(income)
    return (F.when(i < 30000, "<30k").when(i <= 60000, "30-60k")
            .when(i <= 100000, "60-100k").otherwise("100k+"))


def credit_limit_band(limit="credit_limit") -> Column:
    x = _c(limit)
    return (F.when(x == 0, "0").when(x < 5000, "<5k").when(x <= 15000, "5-15k")
            .when(x <= 30000, "15-30k").otherwise("30k+"))


def debt_to_income(debt="total_debt", income="yearly_income") -> Column:
    """total_debt / yearly_income as decimal(9,4); a zero income gives NULL."""
    return (_c(debt) / F.nullif(_c(income), F.lit(0))).cast("decimal(9,4)")


def entry_mode(use_chip="use_chip") -> Column:
    """Text before the first space of use_chip ('Chip Transaction' -> 'Chip');
    'Unknown' where there is none."""
    return F.coalesce(F.substring_index(_c(use_chip), " ", 1), F.lit("Unknown"))


def geo_code(city="merchant_city", state="merchant_state", zip_="zip") -> Column:
    """Composite business key city|state|zip; a NULL part becomes ''."""
    return F.concat_ws("|", F.coalesce(_c(city), F.lit("")), F.coalesce(_c(state), F.lit("")),
                       F.coalesce(_c(zip_), F.lit("")))


def trans_type_code(use_chip="use_chip", errors="errors") -> Column:
    """Composite business key mode|success|error of the junk dimension."""
    return F.concat_ws("|", entry_mode(use_chip),
                       F.when(_c(errors).isNull(), "1").otherwise("0"),
                       F.coalesce(_c(errors), F.lit("None")))


def date_key(ts="date") -> Column:
    """Smart date key YYYYMMDD as int."""
    return F.date_format(F.to_date(_c(ts)), "yyyyMMdd").cast("int")
