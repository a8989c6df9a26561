"""Reading decimal text."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The only non-numeric words that count as numbers, in this
# spelling. A digit anywhere covers numbers too large for a double.
_SPECIAL_WORDS = r"\d|^\s*[+-]?(NaN|Infinity)\s*$"


def number(name: str) -> Column:
    """The column that `with_numbers` adds for text column `name`."""
    return F.col(f"{name}_number")


def with_numbers(df: DataFrame, *names: str) -> DataFrame:
    """Add the value of each text column as a nullable double.

    Unreadable text gives null. Spark also reads `inf` and `nan` in any case;
    those are nulled here. The cast and the check are separate projections so
    that each text is converted once.
    """
    cast = df.withColumns({f"{n}_number": F.col(n).try_cast("double") for n in names})
    return cast.withColumns({f"{n}_number": _strict(number(n), F.col(n)) for n in names})


def _strict(value: Column, text: Column) -> Column:
    return F.when(F.abs(value) < float("inf"), value).when(text.rlike(_SPECIAL_WORDS), value)
