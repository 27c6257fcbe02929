"""Column expressions shared by the layers. All of them stay in generated JVM code."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Money is added up as decimals so that a sum does not depend on the order of rows;
# six places keep sub-cent prices whole.
MONEY = "DECIMAL(28,6)"


def blank_to_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Strip spaces and turn empty text into NULL; names the frame lacks are ignored."""
    present = [name for name in columns if name in df.columns]
    return df.withColumns({name: F.nullif(F.trim(name), F.lit("")) for name in present})


def fold_rules(rules: Mapping[str, str]) -> Column:
    """Comma-joined codes of the rules whose condition is true, NULL if there is none.

    ``rules`` maps a code to a SQL condition; a condition that is NULL raises nothing.
    """
    codes = [F.when(F.expr(condition), F.lit(code)) for code, condition in rules.items()]
    return F.nullif(F.concat_ws(",", *codes), F.lit(""))


def money_sum(column: Column) -> Column:
    """Order-independent sum of a double column, as a double."""
    return F.sum(column.cast(MONEY)).cast("double")


def attribute_hash(columns: Sequence[str]) -> Column:
    """SHA-256 fingerprint of several attributes."""
    # The NULL marker and the separator of the fingerprint text.
    null_marker, separator = "__NULL__", "||"
    parts = [F.coalesce(F.col(name).cast("string"), F.lit(null_marker)) for name in columns]
    return F.sha2(F.concat_ws(separator, *parts), 256)


def differs(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """True when any pair of columns differs, NULL counting as an ordinary value."""
    same = F.lit(True)
    for a, b in zip(left, right, strict=True):
        same = same & a.eqNullSafe(b)
    return ~same


def day_number(column: str) -> Column:
    """A date as the integer yyyyMMdd."""
    return (F.year(column) * 10000 + F.month(column) * 100 + F.dayofmonth(column)).cast("int")


def on_weekend(column: str) -> Column:
    return F.dayofweek(column).isin(1, 7)
