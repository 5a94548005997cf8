"""Column expressions shared by the operators.  All are built-in Spark functions,
so they stay inside whole-stage codegen; nothing here runs Python per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bool_flag(c) -> Column:
    """Text or boolean -> 1 / 0 / NULL.

    Only a case-insensitive 'true' or 'false' (after a cast to string) counts;
    '1', '0', 't', 'yes', blanks and NULL all give NULL.  Real booleans cast to
    'true' / 'false' and therefore work too.
    """
    text = F.lower(_col(c).cast("string"))
    return (F.when(text == F.lit("true"), F.lit(1))
             .when(text == F.lit("false"), F.lit(0))
             .otherwise(F.lit(None).cast("int")))


def flag_else_zero(cond: Column) -> Column:
    """CASE WHEN cond THEN 1 ELSE 0 END (a NULL condition gives 0)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def flag_or_null(cond: Column) -> Column:
    """CASE WHEN cond THEN 1 END, so that count() only counts rows where cond holds."""
    return F.when(cond, F.lit(1))


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator as double; a zero denominator gives NULL instead of an error."""
    return F.try_divide(numerator, denominator)


def round_half_even(c) -> Column:
    """ROUND on a REAL/DOUBLE the way PostgreSQL does it on floats (ties to even)."""
    return F.rint(_col(c))


def float_to_int(c, type_name: str = "int") -> Column:
    """``real::integer`` semantics: round to nearest (ties to even), then cast.

    A plain Spark cast truncates; with ANSI mode an out-of-range value raises,
    as the source database does.
    """
    return F.rint(_col(c)).cast(type_name)


def parse_pg_boolean(c) -> Column:
    """Text -> boolean accepting the spellings a PostgreSQL COPY accepts for BOOLEAN.

    Spark's cast already accepts t/true/y/yes/1 and f/false/n/no/0 (any case,
    trimmed); 'on' / 'off' are mapped first.  Anything else raises under ANSI mode,
    as COPY would reject the row.
    """
    text = F.lower(F.trim(_col(c).cast("string")))
    mapped = (F.when(text == F.lit("on"), F.lit("true"))
               .when(text == F.lit("off"), F.lit("false"))
               .otherwise(text))
    return mapped.cast("boolean")


def date_path(ts) -> Column:
    """Timestamp -> 'YYYY/MM/DD' folder text (session time zone, UTC in this project)."""
    return F.date_format(_col(ts), "yyyy/MM/dd")


def map_value(map_col, key: str) -> Column:
    """Element of a map column by key; an absent key gives NULL."""
    return _col(map_col)[key]
