"""Calendar columns derived from a publish time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def date_parts(df: DataFrame, published: str | Column = "datePublished") -> DataFrame:
    """Add year, month, day, first-of-month and first-of-year."""
    c = F.col(published) if isinstance(published, str) else published
    day = F.to_date(c)
    return df.withColumns({
        "year_published": F.year(day),
        "month_published": F.month(day),
        "date_published": day,
        "month_date": F.trunc(day, "month"),
        "year_date": F.trunc(day, "year"),
    })


def month_date(year: str = "year_published", month: str = "month_published") -> Column:
    return F.make_date(F.col(year), F.col(month), F.lit(1))


def year_date(year: str = "year_published") -> Column:
    return F.make_date(F.col(year), F.lit(1), F.lit(1))
