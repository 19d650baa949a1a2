"""Dates of varying precision as column expressions, and calendar spines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def strict_day(text: Column) -> Column:
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))


def reported_date(text: Column) -> Column:
    """A day, or a month's first day; a bare year is null."""
    return F.coalesce(strict_day(text), F.when(text.rlike(r"^\d{4}-\d{2}$"), F.concat(text, F.lit("-01")).try_cast("date")))


def days_since(text: Column, run_date: str) -> Column:
    """Days from the reported date to the run, 0 at least; null without a date."""
    day = reported_date(text)
    return F.when(day.isNotNull(), F.greatest(F.datediff(F.lit(run_date).cast("date"), day), F.lit(0)))


def year_of(text: Column, run_date: str) -> Column:
    y = F.substring(text, 1, 4)
    return F.when(y.rlike(r"^\d{4}$"), y).otherwise(run_date[:4])


def recover_month(date: Column, urls: Column, first_published: Column) -> Column:
    """struct(month, provenance) for a bare year with evidence of that year: a dated URL, else first publication."""
    dated = F.filter(F.transform(urls, lambda u: F.concat_ws("-", F.regexp_extract(u, r"/(\d{4})[/-](0[1-9]|1[0-2])(?=[/-])", 1), F.regexp_extract(u, r"/(\d{4})[/-](0[1-9]|1[0-2])(?=[/-])", 2))), lambda m: F.substring(m, 1, 4) == date)
    published = F.when(first_published.rlike(r"^\d{4}-(0[1-9]|1[0-2])") & (F.substring(first_published, 1, 4) == date), F.substring(first_published, 1, 7))
    by_url = F.try_element_at(dated, F.lit(1))
    month = F.coalesce(by_url, published)
    return F.when(date.rlike(r"^\d{4}$") & month.isNotNull(), F.struct(month.alias("month"), F.when(by_url.isNotNull(), "source_url").otherwise("first_published").alias("provenance")))


def month_spine(spark: SparkSession, run_date: str, months: int = 24) -> DataFrame:
    return spark.sql(f"select date_format(d, 'yyyy-MM') month from (select explode(sequence(add_months(trunc(date'{run_date}', 'month'), {1 - months}), trunc(date'{run_date}', 'month'), interval 1 month)) d)")


def day_spine(spark: SparkSession, run_date: str, days: int) -> DataFrame:
    return spark.sql(f"select explode(sequence(date_sub(date'{run_date}', {days - 1}), date'{run_date}')) day")
