"""Columns with a meaning in the domain: classes of codes and months."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymill.schema import CODE_CLASS


def code_class(code: Column) -> Column:
    """Class of an irregularity code, null when the code is unknown.

    One branch per class with a literal IN list, so no join and no shuffle.
    """
    classes = sorted(set(CODE_CLASS.values()))
    result = F.lit(None).cast("string")
    for name in classes:
        codes = [c for c, cls in CODE_CLASS.items() if cls == name]
        result = F.when(code.isin(codes), F.lit(name)).otherwise(result)
    return result


def normalised_class(code: Column, source_class: Column) -> Column:
    return F.coalesce(code_class(code), source_class)


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM").cast("date")


def previous_month(day: Column) -> Column:
    return F.add_months(month_start(day), -1)


def month_number(day: Column) -> Column:
    """Months since year 0, so that the month before is this minus one."""
    return F.year(day) * 12 + F.month(day)
