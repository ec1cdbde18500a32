"""Functions on text columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values.
STEP_WORDS = ("left", "right", "straight", "none")
TRACE = "T"
TRACE_VALUE = -1.0


def flag_from_letter(flag: Column, yes: str = "Y") -> Column:
    """1 for ``yes``, 0 for anything else including a missing flag."""
    return F.when(flag == yes, 1).otherwise(0)


def measured_or_trace(text: Column) -> Column:
    """Weather reading as a number, with the trace mark turned into its own value."""
    return F.when(F.trim(text) == TRACE, F.lit(TRACE_VALUE)).otherwise(text.try_cast("double"))


def count_word(text: Column, word: str) -> Column:
    """Non-overlapping occurrences of ``word`` anywhere in the text ("slight left" counts as left)."""
    return F.regexp_count(text, F.lit(word))
