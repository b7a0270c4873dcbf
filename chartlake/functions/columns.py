"""Scalar column functions used by the operators.

Spark 4 runs with ANSI mode on: ``arr[0]`` on an empty array, ``to_date`` on
bad text and ``make_date`` on an impossible date all raise. The reference's
semantics are the "safe" ones (NULL instead of an error), so every helper
here is the NULL-returning variant.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def first_of(arr) -> Column:
    """``arr[SAFE_OFFSET(0)]``: first element, NULL for a NULL or empty array."""
    return F.get(_c(arr), 0)


def first_field(arr, field: str) -> Column:
    """``arr[SAFE_OFFSET(0)].field``."""
    return first_of(arr).getField(field)


def safe_date(year, month, day) -> Column:
    """``DATE(y, m, d)`` that yields NULL for an impossible date instead of
    failing the whole job (one bad partition path must not kill a 100 TB run)."""
    z = F.lit(0)
    return F.try_make_timestamp_ntz(_c(year), _c(month), _c(day), z, z, z).cast("date")


def _guard_year(d: Column) -> Column:
    # The source warehouse's DATE range is 0001-01-01..9999-12-31; Spark would
    # accept year 0, which then cannot be collected to Python.
    return F.when(F.year(d) >= 1, d)


def parse_partial_date(text, precision) -> Column:
    """Precision-aware release-date parse.

    day -> ``Y-m-d``, month -> ``Y-m`` (first of month), year -> ``Y``
    (1 January); any other precision, NULL precision or unparsable text
    -> NULL. One- or two-digit month/day are both accepted."""
    t, p = _c(text), _c(precision)
    parsed = (F.when(p == "day", F.try_to_date(t, "yyyy-M-d"))
               .when(p == "month", F.try_to_date(t, "yyyy-M"))
               .when(p == "year", F.try_to_date(t, "yyyy")))
    return _guard_year(parsed)


# The decade buckets and their display order (must match the
# reference output exactly). Years >= 2020 are open-ended; years before 1920
# fall into the catch-all bucket.
DECADE_ORDER = ["2020s", "2010s", "2000s", "1990s", "1980s", "1970s", "1960s",
                "1950s", "1940s", "1930s", "1920s"]
OTHER_DECADE = "Older or Unknown"
OTHER_DECADE_RANK = 13


def release_decade(year) -> Column:
    """Bucket a release year into a decade label."""
    y = _c(year)
    expr = None
    for label in DECADE_ORDER:
        lo = int(label[:4])
        expr = F.when(y >= lo, label) if expr is None else expr.when(y >= lo, label)
    return expr.otherwise(OTHER_DECADE)


def decade_rank(label) -> Column:
    """Chronological (newest first) sort key of a decade label."""
    lab = _c(label)
    expr = None
    for i, name in enumerate(DECADE_ORDER, start=1):
        expr = F.when(lab == name, i) if expr is None else expr.when(lab == name, i)
    return expr.otherwise(OTHER_DECADE_RANK)
