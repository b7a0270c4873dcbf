"""Column-expression helpers (all built-in, JVM-side, codegen friendly)."""
from .columns import first_of, first_field, safe_date, parse_partial_date, release_decade, DECADE_ORDER, decade_rank

__all__ = ["first_of", "first_field", "safe_date", "parse_partial_date",
           "release_decade", "DECADE_ORDER", "decade_rank"]
