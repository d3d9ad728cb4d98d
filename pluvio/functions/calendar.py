"""Date attributes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.functions import lit

# Portuguese month and weekday names, in calendar order from January and from Sunday.
MONTHS_PT = [
    "Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho",
    "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro",
]
WEEKDAYS_PT = [
    "Domingo", "Segunda-feira", "Terça-feira", "Quarta-feira", "Quinta-feira", "Sexta-feira", "Sábado",
]
SEASONS_PT = ["Verão", "Outono", "Inverno", "Primavera"]
# First day of autumn, winter, spring and summer as month * 100 + day (southern hemisphere).
SEASON_STARTS = [321, 621, 923, 1221]


def date_parts(c: Column, *parts: str) -> list[Column]:
    """Integer columns named after the parts: year, month, day, quarter, hour."""
    return [F.date_part(lit(p), c).cast("int").alias(p) for p in parts]


def year_month(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def dow(c: Column) -> Column:
    """0 is Sunday, 6 is Saturday."""
    return F.dayofweek(c) - 1


def is_weekend(c: Column) -> Column:
    return F.dayofweek(c).isin(1, 7)


def sunday_week(c: Column) -> Column:
    """Week of the year with weeks starting on Sunday; days before the first Sunday are week 0."""
    return F.floor((F.dayofyear(c) + 6 - dow(c)) / 7).cast("int")


def season(c: Column) -> Column:
    autumn, winter, spring, summer = SEASON_STARTS
    day = F.month(c) * 100 + F.day(c)
    return (
        F.when((day < autumn) | (day >= summer), SEASONS_PT[0])
        .when(day < winter, SEASONS_PT[1])
        .when(day < spring, SEASONS_PT[2])
        .when(day < summer, SEASONS_PT[3])
    )


def _name(names: list[str], position: Column) -> Column:
    return F.element_at(F.array(*map(lit, names)), position)


def month_name_pt(c: Column, short: bool = False) -> Column:
    return _name([m[:3] if short else m for m in MONTHS_PT], F.month(c))


def weekday_name_pt(c: Column, short: bool = False) -> Column:
    return _name([d[:3] if short else d for d in WEEKDAYS_PT], F.dayofweek(c))


def quarter_labels(c: Column) -> tuple[Column, Column]:
    quarter = F.quarter(c).cast("string")
    return F.concat(quarter, lit("º Tri")), F.concat(lit("Q"), quarter)
