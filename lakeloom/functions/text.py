"""String helpers shared by the other functions.

Longer expressions are written as SQL text: the text is parsed once, where the
same thing built from Column objects would take hundreds of calls.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's str.strip() removes; Spark's trim() alone knows
# only the space.
WHITESPACE = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace())

# Control characters and space, which URL parsers drop at the ends.
CONTROL_OR_SPACE = "".join(map(chr, range(0x21)))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def null_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def literal(text: str) -> str:
    """``text`` as a SQL string literal."""
    plain = (f"\\u{ord(c):04X}" if c in "'\\" or c < " " else c for c in text)
    return "'" + "".join(plain) + "'"


def literal_map(table: dict[str, str]) -> str:
    """A constant map as SQL, folded once by the optimizer."""
    sep = "\x1f"
    keys, values = literal(sep.join(table)), literal(sep.join(table.values()))
    return f"map_from_arrays(split({keys}, '\\u001f'), split({values}, '\\u001f'))"


def let(name: str, value: str, body: str) -> str:
    """SQL for ``body``, in which ``name`` stands for ``value``, evaluated once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def apply_sql(body: str, **columns: Column) -> Column:
    """SQL over columns: ``body`` sees them as ``x.<name>``."""
    row = F.array(F.struct(*(c.alias(name) for name, c in columns.items())))
    return F.element_at(F.call_function("transform", row, F.expr(f"x -> {body}")), 1)
