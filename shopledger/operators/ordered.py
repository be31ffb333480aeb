"""Order-dependent operators that never put a whole key into one task.

A plain ``Window.partitionBy(employee)`` sends every row of an employee to a
single task.  Here each key is cut into buckets along its own order (a day, a
file split, ...).  The wide rows are windowed per (key, bucket); only one small
row per bucket crosses bucket borders and is windowed per key.  The result is
exactly that of the plain window.

The input is read twice (once for the rows, once - with few columns and map-side
aggregation - for the bucket rows), so callers chaining several of these
operators store the intermediate table first (``session.store``).

``order`` has to be a total order within a key, up to identical rows, and
``bucket`` has to be non-decreasing along it.  Key and bucket must not be null.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopledger.session import store

_BUCKET = "__bucket"


def _bucketed(df: DataFrame, bucket: Column | Sequence[Column]) -> tuple[DataFrame, list[str]]:
    parts = list(bucket) if isinstance(bucket, (list, tuple)) else [bucket]
    names = [f"{_BUCKET}{i}" for i in range(len(parts))]
    return df.withColumns(dict(zip(names, parts, strict=True))), names


def _join_edges(rows: DataFrame, edges: DataFrame, on: list[str]) -> DataFrame:
    # A plain equi-join on the window's own partitioning: the wide side is not shuffled again.
    return rows.join(edges, on, "left")


def neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    bucket: Column | Sequence[Column],
    lag: Mapping[str, str] | None = None,
    lead: Mapping[str, str] | None = None,
    running: Mapping[str, Column] | None = None,
    fill: Mapping[str, str] | None = None,
    deep: bool = False,
) -> DataFrame:
    """Add lag / lead / running-sum / forward-fill columns per key.

    ``lag`` and ``lead`` map new column -> source column, ``running`` maps new
    column -> summed expression (inclusive), ``fill`` maps new column -> column
    whose last non-null value up to the row is wanted.

    ``deep`` is for keys with very many buckets: the buckets' own rows are
    carried on in buckets of all but the last of the bucket columns, and so on,
    so that a task sees no more of a key than the values of the first. Not with
    ``lead``.
    """
    lag, lead, running, fill = dict(lag or {}), dict(lead or {}), dict(running or {}), dict(fill or {})
    keys, order = list(keys), list(order)
    rows, bcols = _bucketed(df, bucket)
    on = keys + bcols
    at = F.struct(*order)

    aggs: list[Column] = []
    if lag:
        aggs.append(F.max_by(F.struct(*[F.col(c).alias(n) for n, c in lag.items()]), at).alias("__last"))
    if lead:
        aggs.append(F.min_by(F.struct(*[F.col(c).alias(n) for n, c in lead.items()]), at).alias("__first"))
    aggs += [F.sum(expr).alias(f"__sum_{n}") for n, expr in running.items()]
    aggs += [
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), at)).alias(f"__fill_{n}") for n, c in fill.items()
    ]
    edges = rows.groupBy(*on).agg(*aggs)

    if deep and len(bcols) > 1:
        edges = _carried_deep(edges, keys, bcols, lag, running, fill)
    else:
        edges = _carried(edges, keys, bcols, lag, lead, running, fill)

    inside = Window.partitionBy(*on).orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    local: dict[str, Column] = {}
    if lag:
        local["__in_first"] = F.lag(F.lit(1)).over(inside).isNull()
        local.update({f"__lag_{n}": F.lag(c).over(inside) for n, c in lag.items()})
    if lead:
        local["__in_last"] = F.lead(F.lit(1)).over(inside).isNull()
        local.update({f"__lead_{n}": F.lead(c).over(inside) for n, c in lead.items()})
    local.update({f"__run_{n}": F.sum(expr).over(upto) for n, expr in running.items()})
    local.update({f"__ff_{n}": F.last(c, ignorenulls=True).over(upto) for n, c in fill.items()})

    out = _join_edges(rows.withColumns(local), edges, on)
    final: dict[str, Column] = {}
    for n in lag:
        final[n] = F.when(F.col("__in_first"), F.col("__last")[n]).otherwise(F.col(f"__lag_{n}"))
    for n in lead:
        final[n] = F.when(F.col("__in_last"), F.col("__first")[n]).otherwise(F.col(f"__lead_{n}"))
    for n in running:
        final[n] = F.col(f"__run_{n}") + F.coalesce(F.col(f"__sum_{n}"), F.lit(0))
    for n in fill:
        final[n] = F.coalesce(F.col(f"__ff_{n}"), F.col(f"__fill_{n}"))
    return out.select(*[F.col(c) for c in df.columns], *[e.alias(n) for n, e in final.items()])


def _carried(edges: DataFrame, keys: list[str], bcols: list[str], lag: dict, lead: dict, running: dict, fill: dict) -> DataFrame:
    """What each bucket takes over from those before it (and from the one behind it), by a window over the key's buckets."""
    across = Window.partitionBy(*keys).orderBy(*bcols)
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    carried = [F.col(c) for c in (*keys, *bcols)]
    if lag:
        carried.append(F.lag("__last").over(across).alias("__last"))
    if lead:
        carried.append(F.lead("__first").over(across).alias("__first"))
    carried += [F.sum(f"__sum_{n}").over(before).alias(f"__sum_{n}") for n in running]
    carried += [F.last(f"__fill_{n}", ignorenulls=True).over(before).alias(f"__fill_{n}") for n in fill]
    return edges.select(*carried)


def _carried_deep(edges: DataFrame, keys: list[str], bcols: list[str], lag: dict, running: dict, fill: dict) -> DataFrame:
    """The same in levels: each bucket gets the row of the one before, and these are summed and filled like rows."""
    wider = [F.col(c) for c in bcols[:-1]]
    sums, fills = [f"__sum_{n}" for n in running], [f"__fill_{n}" for n in fill]
    names = [*(["__last"] if lag else []), *sums, *fills]
    plain = {c: f"__own{k}" for k, c in enumerate(names)}  # names that the steps below don't use themselves
    # read several times on every level, and small: one row per bucket
    edges = store(edges.withColumnsRenamed(plain), "edges")
    shifted = neighbours(edges, keys, bcols, wider, lag={f"__from{plain[c]}": plain[c] for c in names}, deep=True)
    shifted = store(shifted.drop(*plain.values()), "edges")
    before = lambda c: F.col(f"__from{plain[c]}")
    carried = shifted if not sums + fills else neighbours(
        shifted, keys, bcols, wider, running={f"__until{plain[c]}": F.coalesce(before(c), F.lit(0)) for c in sums},
        fill={f"__until{plain[c]}": f"__from{plain[c]}" for c in fills}, deep=True,
    )
    until = [F.col(f"__until{plain[c]}").alias(c) for c in (*sums, *fills)]
    return carried.select(*keys, *bcols, *([before("__last").alias("__last")] if lag else []), *until)


Cell = Callable[[str], Column]


def mark_runs(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    bucket: Column | Sequence[Column],
    carry: Sequence[str],
    breaks: Callable[[Cell, Cell], Column],
    run: str = "run_no",
) -> DataFrame:
    """Number the runs of consecutive rows of a key (gaps and islands).

    ``breaks(prev, cur)`` says whether a row starts a new run, given accessors
    for the columns named in ``carry`` of the previous and of the current row.
    The first row of a key always starts run 1.
    """
    keys, order, carry = list(keys), list(order), list(carry)
    rows, bcols = _bucketed(df, bucket)
    on = keys + bcols
    inside = Window.partitionBy(*on).orderBy(*order)
    at = F.struct(*order)

    lagged = rows.withColumns(
        {"__head": F.lag(F.lit(1)).over(inside).isNull()}
        | {f"__p_{c}": F.lag(c).over(inside) for c in carry}
    )
    starts = F.coalesce(breaks(lambda c: F.col(f"__p_{c}"), F.col), F.lit(True))
    lagged = lagged.withColumn("__start", F.when(F.col("__head"), 0).otherwise(starts.cast("int")))
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    lagged = lagged.withColumn("__in_run", F.sum("__start").over(upto))

    cells = F.struct(*carry)
    edges = lagged.groupBy(*on).agg(
        F.min_by(cells, at).alias("__first"), F.max_by(cells, at).alias("__last"), F.sum("__start").alias("__n")
    )
    across = Window.partitionBy(*keys).orderBy(*bcols)
    edges = edges.withColumn("__prev", F.lag("__last").over(across))
    at_border = F.coalesce(breaks(lambda c: F.col("__prev")[c], lambda c: F.col("__first")[c]), F.lit(True))
    edges = edges.withColumn(
        "__border", F.when(F.col("__prev").isNull(), 1).otherwise(at_border.cast("int"))
    )
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.select(
        *on, (F.coalesce(F.sum(F.col("__n") + F.col("__border")).over(before), F.lit(0)) + F.col("__border")).alias("__base")
    )
    out = _join_edges(lagged, edges, on)
    return out.select(*[F.col(c) for c in df.columns], (F.coalesce(F.col("__base"), F.lit(0)) + F.col("__in_run")).alias(run))
