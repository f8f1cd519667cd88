"""Text and casting expressions used by the cleaning layers.

All of these are built-in Spark expressions; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tanimart import config


def blank_to_null(c: Column | str) -> Column:
    """'' becomes NULL; anything else (including '  ') is kept."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(c, F.lit(""))


def is_present(c: Column | str) -> Column:
    """True when the value is non-NULL and not blank after trimming spaces.

    NULL input gives NULL, which a ``filter`` treats as false.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.trim(c) != F.lit("")


def safe_number(c: Column | str) -> Column:
    """Text -> double, NULL when the text is not a decimal number or is too
    large for a double (it must not pass as infinity)."""
    c = F.col(c) if isinstance(c, str) else c
    value = F.when(c.rlike(config.NUMBER_PATTERN), F.btrim(c, F.lit(config.NUMBER_PADDING)).try_cast("double"))
    return F.when(F.abs(value) < float("inf"), value)


def positive_or_null(c: Column) -> Column:
    """Keep strictly positive values; zero, negatives and NULL become NULL."""
    return F.when(c > 0, c)


def safe_date(c: Column | str, formats: list[str] | None = None) -> Column:
    """Text -> date using an explicit list of formats, NULL when none fits.

    A year of two digits is one of 1970 to 2069."""
    c = F.col(c) if isinstance(c, str) else c
    fmts = formats or config.DATE_FORMATS

    def parsed(form: str) -> Column:
        date = F.try_to_date(F.trim(c), form)
        if not form.endswith("/yy"):
            return date
        return F.when(F.year(date) > 2069, F.add_months(date, -1200)).otherwise(date)

    return F.coalesce(*[parsed(f) for f in fmts])


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is evaluated once per row, however often and
    under whatever filter it is read: the optimizer copies the expression of a
    projected column into the filters it pushes below joins and projections,
    but moves none below a generator.  Joins that do not read the column still
    go below it."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def normalized_name(c: Column | str) -> Column:
    """Key used to compare names: spaces trimmed, lower-cased."""
    c = F.col(c) if isinstance(c, str) else c
    return F.lower(F.trim(c))


def tokens(text: Column | str) -> Column:
    """ARRAY<STRING> of features: lower-case runs of letters and digits."""
    text = F.col(text) if isinstance(text, str) else text
    parts = F.split(F.lower(text), config.TOKEN_SPLIT_PATTERN)
    return F.filter(parts, lambda t: t != F.lit(""))


def word_count(text: Column | str) -> Column:
    """Number of features in the text (same rule as ``tokens``)."""
    return F.size(tokens(text))


def line_count(text: Column | str) -> Column:
    """Number of lines: newline characters plus one."""
    text = F.col(text) if isinstance(text, str) else text
    return F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + F.lit(1)
