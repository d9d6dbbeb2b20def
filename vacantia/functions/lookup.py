"""Fixed look-up tables as column expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# The currency of each country that postings come from.
CURRENCIES = {
    "AT": "EUR", "BE": "EUR", "DE": "EUR", "ES": "EUR", "FR": "EUR", "IE": "EUR", "IT": "EUR", "NL": "EUR", "AU": "AUD", "BR": "BRL",
    "CA": "CAD", "CH": "CHF", "GB": "GBP", "IN": "INR", "MX": "MXN", "NZ": "NZD", "PL": "PLN", "SG": "SGD", "US": "USD", "ZA": "ZAR",
}
# The spellings of pay intervals, and how many of each make a year.
INTERVALS = {
    "1 year": "annual", "year": "annual", "yearly": "annual", "annual": "annual", "1 month": "monthly", "month": "monthly", "monthly": "monthly",
    "1 week": "weekly", "week": "weekly", "weekly": "weekly", "1 day": "daily", "day": "daily", "daily": "daily", "1 hour": "hourly", "hour": "hourly", "hourly": "hourly",
}
PER_YEAR = {"hourly": 2080.0, "daily": 261.0, "weekly": 52.0, "monthly": 12.0, "annual": 1.0}
# The major groups of the classification of occupations.
MAJORS = {
    "0": "Armed forces", "1": "Managers", "2": "Professionals", "3": "Technicians & associate professionals", "4": "Clerical support workers",
    "5": "Services & sales workers", "6": "Skilled agricultural, forestry, fishery", "7": "Craft & related trades", "8": "Plant & machine operators", "9": "Elementary occupations",
}


def looked_up(c: Column, table: dict[str, object]) -> Column:
    """The table's value for ``c``; null where it has none."""
    return F.try_element_at(F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())]), c)


def currency_of(country: Column) -> Column:
    return looked_up(F.upper(country), CURRENCIES)


def period_of(interval: Column) -> Column:
    return looked_up(F.lower(F.trim(interval)), INTERVALS)


def major_of(isco: Column) -> Column:
    return F.substring(isco, 1, 1)


def major_label(major: Column) -> Column:
    """The name of a major group; 'Unclassified' for null, 'ISCO x' for an unknown x."""
    return F.when(major.isNull(), "Unclassified").otherwise(F.coalesce(looked_up(major, MAJORS), F.concat(F.lit("ISCO "), major)))


def wage_bucket(isco: Column) -> Column:
    """The bucket of a wage cube that covers an occupation: 1 for majors 1-3, 2 for 4-5, 3 for 6-9, null else."""
    m = major_of(isco)
    return F.when(m.isin("1", "2", "3"), "1").when(m.isin("4", "5"), "2").when(m.isin("6", "7", "8", "9"), "3")
