"""Named measures and ratios, and the packs of them that the weekly tables share.

They are plain data: a table's measures also tell which source columns it reads, and a
pack can be reused for any set of keys.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Measure(NamedTuple):
    """An aggregate over one column.  ``how`` is sum, count, distinct or mean."""

    how: str
    column: str


class Ratio(NamedTuple):
    """``num / den * scale``, or ``default`` where ``den`` is not above zero."""

    num: str
    den: str
    scale: int = 1
    default: float | None = 0.0


class Difference(NamedTuple):
    """The first column minus all others."""

    first: str
    others: tuple[str, ...]


def total(column: str) -> Measure:
    return Measure("sum", column)


def count(column: str) -> Measure:
    return Measure("count", column)


def distinct(column: str) -> Measure:
    return Measure("distinct", column)


def mean(column: str) -> Measure:
    return Measure("mean", column)


def minus(first: str, *others: str) -> Difference:
    return Difference(first, others)


def percent(num: str, den: str) -> Ratio:
    return Ratio(num, den, 100)


def aggregate(measure: Measure, dtype: T.DataType) -> Column:
    """The aggregate column of a measure over a column of type ``dtype``.

    Sums run on the stored type, exactly and independent of order for decimals and integers,
    and come out as DOUBLE or BIGINT.  A sum over NULLs only is 0, a mean over them NULL.
    """
    col = f"`{measure.column}`"
    if isinstance(dtype, T.BooleanType):
        col, dtype = f"CAST({col} AS INT)", T.IntegerType()
    if measure.how == "count":
        return F.expr(f"count({col})")
    if measure.how == "distinct":
        return F.expr(f"count(DISTINCT {col})")
    if measure.how == "mean":
        return F.expr(f"try_divide(CAST(sum({col}) AS DOUBLE), CAST(count({col}) AS DOUBLE))")
    if measure.how == "sum":
        out = "BIGINT" if isinstance(dtype, T.IntegralType) else "DOUBLE"
        return F.expr(f"CAST(coalesce(sum({col}), 0) AS {out})")
    raise ValueError(f"unknown measure {measure.how!r}")


def safe_div(
    num: Column | str, den: Column | str, scale: int = 1, default: float | None = 0.0
) -> Column:
    """``num / den * scale`` where ``den`` is above zero, else ``default``."""
    num, den = _column(num).cast("double"), _column(den).cast("double")
    quotient = num / den
    if scale != 1:
        quotient = quotient * F.lit(scale)
    return F.when(den > 0, quotient).otherwise(F.lit(default).cast("double"))


def derived(item: Ratio | Difference) -> Column:
    if isinstance(item, Difference):
        return F.expr(" - ".join(f"`{name}`" for name in (item.first, *item.others)))
    num, den = f"CAST(`{item.num}` AS DOUBLE)", f"CAST(`{item.den}` AS DOUBLE)"
    quotient = f"{num} / {den}" if item.scale == 1 else f"{num} / {den} * {item.scale}"
    default = "NULL" if item.default is None else f"CAST({item.default} AS DOUBLE)"
    return F.expr(f"CASE WHEN {den} > 0 THEN {quotient} ELSE {default} END")


def with_derived(df, items: Mapping[str, Ratio | Difference]):
    """Add every ratio and difference of ``items``."""
    return df.withColumns({name: derived(item) for name, item in items.items()}) if items else df


def _column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# -- packs -------------------------------------------------------------------------------

SALES_TOTALS = {
    "Total_Revenue": total("novusd"),
    "Total_Profit": total("contributionmargin"),
    "Order_Count": count("marketordernumber"),
}
SALES_RATIOS = {
    "AOV": Ratio("Total_Revenue", "Order_Count"),
    "Profit_Margin": percent("Total_Profit", "Total_Revenue"),
}

ORDER_TOTALS = SALES_TOTALS | {
    "Total_Shipping": total("shippingchargesusd"),
    "Total_Discount": total("promodiscountsusd"),
    "Gross_Order_Value": total("grossprodpaymentorder"),
    "Total_Books": total("booksinorder"),
    "Returning_Count": total("isreturningcustomer"),
}
ORDER_RATIOS = SALES_RATIOS | {
    "Profit_Per_Order": Ratio("Total_Profit", "Order_Count"),
    "Average_Discount_Percentage": percent("Total_Discount", "Gross_Order_Value"),
    "Average_Discount_Amount": Ratio("Total_Discount", "Order_Count"),
    "Gross_vs_Net_Difference": minus("Gross_Order_Value", "Total_Revenue"),
    "Returning_Ratio": percent("Returning_Count", "Order_Count"),
    "Average_Order_Size": Ratio("Total_Books", "Order_Count"),
    "Average_Shipping_Cost": Ratio("Total_Shipping", "Order_Count"),
}

DISCOUNT_TOTALS = SALES_TOTALS | {"Total_Discount": total("promodiscountsusd")}
DISCOUNT_RATIO = {"Average_Discount_Amount": Ratio("Total_Discount", "Order_Count")}

AD_TOTALS = {
    "conversions_value": total("conversions_value"),
    "cost": total("cost"),
    "impressions": total("impressions"),
    "clicks": total("clicks"),
    "conversions": total("conversions"),
}
AD_RATIOS = {
    "Profit": minus("conversions_value", "cost"),
    "ROI": Ratio("conversions_value", "cost"),
    "CTR": percent("clicks", "impressions"),
    "Conversion_Rate": percent("conversions", "clicks"),
    "CPC": Ratio("cost", "clicks"),
    "Cost_Per_Conversion": Ratio("cost", "conversions"),
    "Avg_Revenue_Per_Conversion": Ratio("conversions_value", "conversions"),
    "Avg_Revenue_Per_Click": Ratio("conversions_value", "clicks"),
}
SOCIAL_RATIOS = {
    "Profit": minus("revenue", "cost"),
    "ROI": Ratio("revenue", "cost"),
    "CTR": percent("clicks", "impressions"),
    "CPC": Ratio("cost", "clicks"),
    "Avg_Revenue_Per_Click": Ratio("revenue", "clicks"),
}

SESSION_TOTALS = {
    "Total_Sessions": total("sessions"),
    "Avg_Bounce_Rate": mean("bounce_rate"),
    "Total_Active_Users": total("active_users"),
    "Total_Purchase_Revenue": total("purchase_revenue"),
}
