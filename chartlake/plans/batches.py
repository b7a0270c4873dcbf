"""Layers built a stretch of snapshots at a time: the shuffle files of one stretch are gone
before the next one's are written, so a layer's build needs a share of them on disk, not all."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A stretch costs a scan of its source's (or dimension's) rows, so their number is bounded;
# above MAX_BATCHES * BATCH_ROWS a stretch grows with the rows.
BATCH_ROWS = 1_500_000
MAX_BATCHES = 5


def snapshot_batches(rows: DataFrame, date: str, finer: int = 1) -> list[Column | None]:
    """Filters on ``date`` that cut ``rows`` into stretches of following snapshots of about the same number of
    rows: every row, also one without a date, passes exactly one. A snapshot is not cut.
    One pass over the dates; one row per snapshot reaches the driver. ``None``: no need to cut.
    ``finer``: so many times as many stretches."""
    counts = sorted(rows.groupBy(date).count().collect(), key=lambda r: (r[0] is not None, r[0]))
    total = sum(n for _, n in counts)
    batches = min(MAX_BATCHES * finer, -(-total * finer // BATCH_ROWS))
    if batches <= 1:
        return [None]
    ends, seen, share = [], 0, 0
    for day, n in counts[:-1]:
        seen += n
        if day is not None and seen * batches // total > share:
            share = seen * batches // total                  # a hot snapshot may fill several shares
            ends.append(day)
    day = F.col(date)
    if not ends:
        return [None]
    return [(day <= F.lit(ends[0])) | day.isNull(),
            *[(day > F.lit(low)) & (day <= F.lit(high)) for low, high in zip(ends, ends[1:])],
            day > F.lit(ends[-1])]


def key_batches(rows: DataFrame, key: str) -> list[DataFrame]:
    """``rows`` in parts of about BATCH_ROWS rows by a hash of ``key``, MAX_BATCHES at most, for layers
    of a row per key: the parts of such a layer have no key in common."""
    batches = min(MAX_BATCHES, -(-rows.count() // BATCH_ROWS))
    return [rows.filter(F.pmod(F.hash(key), F.lit(batches)) == i) for i in range(batches)] if batches > 1 else [rows]
