"""Display formatting of metric values (currency / count / percent / days / decimal).

Pure Spark expressions: ``format_number`` rounds half-to-even like Python's
``format``; a pattern string gives the no-grouping variants.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import col_or_name

FORMATS = ("currency", "count", "percent", "days", "decimal")


def format_pattern(v: Column, pattern: str) -> Column:
    """``format_number`` with a DecimalFormat pattern (e.g. '0.0': one place,
    no digit grouping, half-to-even)."""
    return F.call_function("format_number", v, F.lit(pattern))


def _one(v: Column, fmt: str, style: str) -> Column:
    if fmt == "currency":
        return F.concat(F.lit("$"), F.format_number(v, 2))
    if fmt == "count":
        # report: int(value) then digit grouping; notebook: rounded to 0 places
        if style == "report":
            return F.format_number(v.cast("bigint"), 0)
        return F.format_number(v, 0)
    if fmt == "percent":
        return F.concat(format_pattern(v, "0.0"), F.lit("%"))
    if fmt == "days":
        return F.concat(v.cast("bigint").cast("string"), F.lit(" days"))
    if fmt == "decimal" and style == "notebook":
        return format_pattern(v, "0.0")
    return format_pattern(v, "0.00")


def format_value(value, fmt, style: str = "report") -> Column:
    """Format ``value`` for display.

    ``fmt`` is a format name or a string column holding one per row.
    ``style='report'`` shows a missing value as ``"0"``; ``style='notebook'``
    treats a missing value as 0 before formatting.
    """
    v = col_or_name(value).cast("double")
    if style == "notebook":
        v = F.coalesce(v, F.lit(0.0))
    if isinstance(fmt, str):
        out = _one(v, fmt, style)
    else:
        out = None
        for name in FORMATS:
            branch = _one(v, name, style)
            out = F.when(fmt == name, branch) if out is None else out.when(fmt == name, branch)
        out = out.otherwise(_one(v, "other", style))
    if style == "report":
        out = F.when(v.isNull(), F.lit("0")).otherwise(out)
    return out
