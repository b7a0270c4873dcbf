"""Latest row per key (OP-08): SCD-1 "newest snapshot wins"."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN, _V = "__rn", "__v"


def _orderable(dtype: str) -> bool:
    return "map<" not in dtype and "variant" not in dtype


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Column | str,
                  tiebreak: Sequence[Column | str] | None = None,
                  method: str = "auto") -> DataFrame:
    """Keep, for every non-NULL key, the row with the greatest ``order``.

    Ties on ``order`` go to the greatest ``tiebreak`` values, compared in
    sequence with NULL lowest (``DESC NULLS LAST``). By default every
    remaining orderable column is a tie-break, so the choice is
    deterministic and reproducible by any SQL engine.

    Plans. ``aggregate`` (the default when ``order`` and ``tiebreak`` are
    plain column names): ``max((order, tiebreak..., rest...))`` per key, the
    remaining columns breaking the ties that ``tiebreak`` leaves; if one of those
    can't be ordered, ``max_by(row, (order, tiebreak...))``. It is a partial
    aggregate, so each task sends at most one row per key through the
    shuffle, and a hot key costs one row per task. ``window``
    (used when explicit sort expressions are given): ``row_number() = 1``,
    where Catalyst's partial ``WindowGroupLimit`` prunes the same way before
    the shuffle. Both give identical rows."""
    keys = list(keys)
    named = isinstance(order, str) and (tiebreak is None or all(isinstance(c, str) for c in tiebreak))
    if tiebreak is None:
        skip = set(keys) | ({order} if isinstance(order, str) else set())
        tiebreak = [c for c, t in df.dtypes if c not in skip and _orderable(t)]
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    base = df.filter(cond)
    if method == "aggregate" or (method == "auto" and named):
        if not named:
            raise ValueError("the aggregate plan needs column names for order and tiebreak")
        names = [c for c in dict.fromkeys([order, *tiebreak]) if c not in keys]     # keys are equal in a group
        rest = [(c, t) for c, t in df.dtypes if c not in names and c not in keys]
        if all(_orderable(t) for _, t in rest):
            # The rank is the whole row: one struct is kept and shuffled, not two.
            names += [c for c, _ in rest]
            if not names:
                return base.dropDuplicates(keys)
            out = base.groupBy(*keys).agg(F.max(F.struct(*names)).alias(_V))
            return out.select(*keys, f"{_V}.*").select(*df.columns)
        rank = F.struct(*[F.col(c) for c in names])
        row = F.struct(*[F.col(c) for c in df.columns if c not in keys])
        out = base.groupBy(*keys).agg(F.max_by(row, rank).alias(_V))
        return out.select(*keys, f"{_V}.*").select(*df.columns)
    order_col = F.col(order) if isinstance(order, str) else order
    tb = [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in tiebreak]
    w = Window.partitionBy(*keys).orderBy(order_col.desc_nulls_last(), *tb)
    return (base.withColumn(_RN, F.row_number().over(w))
                .filter(F.col(_RN) == 1)
                .drop(_RN))
