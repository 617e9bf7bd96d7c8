"""Column-expression helpers (all JVM-side Spark expressions, no UDFs)."""

from .columns import *  # noqa: F401,F403
from .format import format_value  # noqa: F401
