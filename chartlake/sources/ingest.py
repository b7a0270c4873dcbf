"""One ingest run (the reference's Entry 1, re-aimed): the k best items of a
source frame for this run -> NDJSON under the run's ``year=/month=/day=``
partition of the feed. Source frame -> OP-04 -> OP-03."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.topk import DEFAULT_K, check_kind
from .landing import write_landing


def top_items(items: DataFrame, score: Column | str, k: int = DEFAULT_K,
              tiebreak: str = "id") -> DataFrame:
    """The ``k`` best rows by ``score`` (ties: smaller ``tiebreak``). Planned
    as TakeOrderedAndProject: every task keeps its k best, then k·tasks rows
    are merged; no task ever holds more than that."""
    sc = F.col(score) if isinstance(score, str) else score
    return items.orderBy(sc.desc_nulls_last(), F.col(tiebreak).asc_nulls_last()).limit(k)


def ingest_run(items: DataFrame, kind: str, score: Column | str, landing_root: str,
               run_ts: dt.datetime, k: int = DEFAULT_K, keep_score: bool = False) -> DataFrame:
    """Write this run's top-k ``kind`` items (``tracks`` or ``artists``) as
    compact JSON lines under ``landing_root/kind/year=…/month=…/day=…``.
    A score given by column name is left out of the item unless
    ``keep_score`` (it is an item field, e.g. popularity). Returns the written lines
    (lazy). An item whose fields are all NULL is an item; an empty source writes
    nothing."""
    check_kind(kind)
    best = top_items(items, score, k)
    sc = score if isinstance(score, str) and not keep_score else None
    cols = [c for c in best.columns if c != sc]
    lines = best.select(
        F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("value"))
    write_landing(lines, f"{landing_root.rstrip('/')}/{kind}", run_ts=run_ts)
    return lines


def ingest_feeds(feeds: dict[str, tuple[DataFrame, Column | str]], landing_root: str,
                 run_ts: dt.datetime, k: int = DEFAULT_K,
                 keep_score: bool = False) -> dict[str, str]:
    """One scheduled run over both feeds (``{"tracks": (items, score),
    "artists": (items, score)}``), all stamped with the same run timestamp.
    A failing feed does not stop the other one; the outcome of each feed is
    returned (``"ok"`` or the error text)."""
    status: dict[str, str] = {}
    for kind, (items, score) in feeds.items():
        try:
            ingest_run(items, kind, score, landing_root, run_ts, k, keep_score)
            status[kind] = "ok"
        except Exception as e:  # one feed failing must not lose the other
            status[kind] = f"error: {e}"
    return status
