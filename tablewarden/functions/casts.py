"""Casts of dirty text that give NULL and stay cheap when many values are bad.

A lenient cast of text that is no whole number or no boolean costs an exception per value
inside Spark, about a hundred times a good cast. A pattern that lets through everything
the cast may accept keeps such values away from it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE_TYPES = {"tinyint", "smallint", "int", "integer", "bigint", "long"}

# Blanks and control characters are trimmed by the cast; the rest is sign, digits, point.
_MAYBE_WHOLE = r"^[\x00-\x20\x7F]*[+-]?[0-9]*[.]?[0-9]*[\x00-\x20\x7F]*$"
_MAYBE_BOOLEAN = r"(?i)^[\x00-\x20\x7F]*(t|true|y|yes|1|f|false|n|no|0)[\x00-\x20\x7F]*$"


def lenient_cast(value: Column, source: T.DataType, target: str) -> Column:
    """Same result as ``try_cast``; ``source`` is the type of ``value``."""
    cast = value.try_cast(target)
    if not isinstance(source, T.StringType):
        return cast
    if target.lower() in _WHOLE_TYPES:
        return F.when(value.rlike(_MAYBE_WHOLE), cast)
    if target.lower() == "boolean":
        return F.when(value.rlike(_MAYBE_BOOLEAN), cast)
    return cast
