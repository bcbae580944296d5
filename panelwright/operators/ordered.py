"""Order-dependent operators: positions, gaps, lags, rolling means, splits.

A panel has one row per (entity, period), so the only thing that can grow
without bound inside an entity is the number of periods.  Work is therefore cut
into segments of at most ``segment_rows`` consecutive periods; what a segment
must know of its neighbours travels as one summary row (counts, nearest values)
or as a halo of a few repeated rows.  An entity with a third of all rows is
spread over many tasks and the result is exactly the unsegmented one.

``segment_rows=None`` uses one window per entity; choose it only for series
whose length is bounded, such as annual data - ``choose_segments`` finds out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.functions.numeric import col, present, q

SEGMENT_ROWS = 4096

POS, TOTAL, SEG, BLOCK = "__pos", "__n", "__seg", "__block"


def _keys(names: list[str]) -> list[Column]:
    return [col(n) for n in names]


def _in_series(df: DataFrame, entity_cols: list[str], period: str) -> DataFrame:
    """Rows without an entity or a period belong to no series."""
    return df.dropna(subset=[q(k) for k in [*entity_cols, period]])


def with_position(df: DataFrame, entity_cols: list[str] = ["entity"], period: str = "period",
                  segment_rows: int | None = SEGMENT_ROWS) -> DataFrame:
    """Add ``__pos`` (1-based row position in the entity), ``__n`` (its row count), ``__seg``."""
    keys = _keys(entity_cols)
    df = _in_series(df, entity_cols, period)
    if segment_rows is None:
        whole = Window.partitionBy(*keys)
        return (df.withColumn(SEG, F.lit(0).cast("bigint"))
                .withColumn(POS, F.row_number().over(whole.orderBy(col(period))).cast("bigint"))
                .withColumn(TOTAL, F.count(F.lit(1)).over(whole)))
    tagged = df.withColumn(SEG, F.floor(col(period) / F.lit(segment_rows)).cast("bigint"))
    sizes = tagged.groupBy(*keys, SEG).agg(F.count(F.lit(1)).alias("__rows"))
    of_entity = Window.partitionBy(*keys)
    before = of_entity.orderBy(SEG).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *keys, SEG,
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"),
        F.sum("__rows").over(of_entity).alias(TOTAL),
    )
    local = Window.partitionBy(*keys, SEG).orderBy(col(period))
    return (
        tagged.join(offsets, [*entity_cols, SEG])
        .withColumn(POS, F.col("__before") + F.row_number().over(local))
        .drop("__before")
    )


def _drop_marks(df: DataFrame) -> DataFrame:
    return df.drop(POS, TOTAL, SEG)


def series_span(df: DataFrame, period: str = "period") -> int:
    """Upper bound of the rows of any one series: the number of periods in the data.

    One aggregate over a single column.  (entity, period) is unique in a panel,
    so no series can be longer.
    """
    low, high = df.agg(F.min(col(period)), F.max(col(period))).first()
    return 0 if low is None else int(high) - int(low) + 1


def choose_segments(df: DataFrame, period: str = "period",
                    limit: int = SEGMENT_ROWS) -> int | None:
    """``None`` (one window per entity) when every series provably fits, else the segment size.

    Call it once on the narrowest source and hand the answer to every operator:
    it saves them the extra pass that counts rows per segment.
    """
    return None if series_span(df, period) <= limit else limit


def _numbered(df: DataFrame, entity_cols: list[str], period: str,
              segment_rows: int | None) -> tuple[DataFrame, list[str]]:
    """Add the segment and the row number ``__r`` inside it."""
    seg = F.lit(0) if segment_rows is None else F.floor(col(period) / F.lit(segment_rows))
    tagged = _in_series(df, entity_cols, period).withColumn(SEG, seg.cast("bigint"))
    if segment_rows is not None:
        # A join on the segment implies this filter on one side; stating it keeps both
        # sides alike, so that they share one shuffle.
        tagged = tagged.filter(F.col(SEG).isNotNull())
    groups = entity_cols if segment_rows is None else [*entity_cols, SEG]
    local = Window.partitionBy(*_keys(groups)).orderBy(col(period))
    return tagged.withColumn("__r", F.row_number().over(local).cast("bigint")), groups


def _carried_edges(numbered: DataFrame, columns: list[str], entity_cols: list[str], period: str,
                   by_period: bool) -> DataFrame:
    """Per segment: rows before it, and per column the nearest filled value outside it.

    The edges come from the same shuffle as the rows (an aggregate on its keys);
    only one row per segment moves on.
    """
    edges = []
    for i, c in enumerate(columns):
        spot = F.when(col(c).isNotNull(), col(period) if by_period else F.col("__r"))
        edges += [
            F.max_by(col(c), spot).alias(f"__tv{i}"), F.max(spot).alias(f"__tp{i}"),
            F.min_by(col(c), spot).alias(f"__hv{i}"), F.min(spot).alias(f"__hp{i}"),
        ]
    keys = _keys(entity_cols)
    summary = numbered.groupBy(*keys, SEG).agg(F.count(F.lit(1)).alias("__rows"), *edges)
    by_entity = Window.partitionBy(*keys)
    earlier = by_entity.orderBy(SEG).rowsBetween(Window.unboundedPreceding, -1)
    later = by_entity.orderBy(F.col(SEG).desc()).rowsBetween(Window.unboundedPreceding, -1)
    placed = summary.withColumn("__before", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)))
    shift = F.lit(0) if by_period else F.col("__before")
    carried = []
    for i in range(len(columns)):
        carried += [
            F.last(f"__tv{i}", True).over(earlier).alias(f"__pv{i}"),
            F.last(F.col(f"__tp{i}") + shift, True).over(earlier).alias(f"__pp{i}"),
            F.last(f"__hv{i}", True).over(later).alias(f"__nv{i}"),
            F.last(F.col(f"__hp{i}") + shift, True).over(later).alias(f"__np{i}"),
        ]
    return placed.select(*keys, SEG, "__before", *carried)


def fill_missing(df: DataFrame, columns: list[str] | None = None,
                 entity_cols: list[str] = ["entity"], period: str = "period",
                 method: str = "linear", by: str = "position",
                 segment_rows: int | None = SEGMENT_ROWS) -> DataFrame:
    """Fill gaps of each series.

    ``linear`` interpolates between the neighbouring values - spaced by row
    position (default) or by ``period`` - then extends the first value backward
    and the last value forward.  ``ffill_bfill`` carries forward, then backward.
    An all-null series stays null.
    """
    if method not in ("linear", "ffill_bfill"):
        raise ValueError(f"unknown fill method {method!r}")
    if by not in ("position", "period"):
        raise ValueError("by must be 'position' or 'period'")
    names = columns or [c for c in df.columns if c not in {*entity_cols, period}]
    by_period = by == "period"
    rows, groups = _numbered(df, entity_cols, period, segment_rows)
    segmented = segment_rows is not None
    if segmented:
        edges = _carried_edges(rows, names, entity_cols, period, by_period)
        rows = rows.join(edges, [*entity_cols, SEG])
    at = col(period) if by_period else F.col("__r") + (F.col("__before") if segmented else F.lit(0))
    rows = rows.withColumn("__at", at.cast("double"))
    local = Window.partitionBy(*_keys(groups)).orderBy(col(period))
    # Both looks use a frame that grows row by row: Spark re-reads the rest of the
    # group for every row of an "unbounded following" frame, which is quadratic.
    back = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = Window.partitionBy(*_keys(groups)).orderBy(col(period).desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)

    def nearest(c: str, i: int) -> list[Column]:
        spot = F.when(col(c).isNotNull(), F.col("__at"))
        found = {
            "pv": F.last(col(c), True).over(back), "pp": F.last(spot, True).over(back),
            "nv": F.last(col(c), True).over(ahead), "np": F.last(spot, True).over(ahead),
        }
        return [
            (F.coalesce(e, F.col(f"__{k}{i}")) if segmented else e).alias(f"__{k}_{i}")
            for k, e in found.items()
        ]

    steps = rows.select("*", *[e for i, c in enumerate(names) for e in nearest(c, i)])

    def filled(i: int, c: str) -> Column:
        pv, pp, nv, np_ = (F.col(f"__{k}_{i}") for k in ("pv", "pp", "nv", "np"))
        if method == "ffill_bfill":
            return F.coalesce(col(c), pv, nv)
        between = pv + (nv - pv) * F.try_divide(F.col("__at") - pp, np_ - pp)
        return F.coalesce(col(c), between, pv, nv)

    place = {c: i for i, c in enumerate(names)}
    return steps.select(*[
        filled(place[c], c).alias(c) if c in place else col(c) for c in df.columns
    ])


def _with_halo(df: DataFrame, reach: int, entity_cols: list[str], period: str,
               segment_rows: int | None) -> tuple[DataFrame, Window]:
    """Blocks of positions where each block also sees the ``reach`` rows before it."""
    placed = with_position(df, entity_cols, period, segment_rows)
    if segment_rows is None:
        return (placed.withColumn("__own", F.lit(True)),
                Window.partitionBy(*_keys(entity_cols)).orderBy(POS))
    size = max(segment_rows, reach)
    home = F.floor((F.col(POS) - 1) / F.lit(size)).cast("bigint")
    near_end = F.pmod(F.col(POS) - 1, F.lit(size)) >= size - reach
    blocks = (
        placed.withColumn("__home", home)
        .withColumn(BLOCK, F.explode(
            F.when(near_end, F.array("__home", F.col("__home") + 1)).otherwise(F.array("__home"))
        ))
        .withColumn("__own", F.col(BLOCK) == F.col("__home"))
    )
    return blocks, Window.partitionBy(*_keys(entity_cols), BLOCK).orderBy(POS)


def _own_rows(df: DataFrame) -> DataFrame:
    return _drop_marks(df.filter("__own").drop("__own", "__home", BLOCK))


def add_lag_features(df: DataFrame, columns: list[str], lags: int = 1,
                     entity_cols: list[str] = ["entity"], period: str = "period",
                     segment_rows: int | None = SEGMENT_ROWS) -> DataFrame:
    """Add ``<col>_lag1 .. <col>_lagN`` (row shift), then drop rows with any missing value.

    Unknown columns are skipped.
    """
    if lags < 0:
        raise ValueError("lags must be non-negative")
    names = present(df, columns)
    out = df
    if names and lags:
        blocks, w = _with_halo(df, lags, entity_cols, period, segment_rows)
        out = _own_rows(blocks.select("*", *[
            F.lag(col(c), k).over(w).alias(f"{c}_lag{k}")
            for c in names for k in range(1, lags + 1)
        ])).select(*_keys(df.columns), *[
            col(f"{c}_lag{k}") for c in names for k in range(1, lags + 1)
        ])
    values = [c for c in out.columns if c not in {*entity_cols, period}]
    return out.dropna(how="any", subset=[q(c) for c in values]) if values else out


def moving_average(df: DataFrame, columns: list[str], window: int = 5,
                   entity_cols: list[str] = ["entity"], period: str = "period",
                   suffix: str = "_ma", segment_rows: int | None = SEGMENT_ROWS) -> DataFrame:
    """Rolling mean over ``window`` rows; NULL until the window is full or if it has a gap.

    A series with at most ``window`` rows gets no average.
    """
    if window < 1:
        raise ValueError("window must be at least 1")
    blocks, w = _with_halo(df, window - 1, entity_cols, period, segment_rows)
    frame = w.rowsBetween(-(window - 1), Window.currentRow)
    averaged = blocks.select("*", *[
        F.when((F.count(col(c)).over(frame) == window) & (F.col(TOTAL) > window),
               F.avg(col(c)).over(frame)).alias(f"{c}{suffix}")
        for c in columns
    ])
    return _own_rows(averaged).select(*_keys(df.columns), *[col(f"{c}{suffix}") for c in columns])


def temporal_split(df: DataFrame, train_end: int = 2010,
                   period: str = "period") -> tuple[DataFrame, DataFrame]:
    """Train rows up to ``train_end`` inclusive, test rows after it."""
    return df.filter(col(period) <= train_end), df.filter(col(period) > train_end)


def proportional_split(df: DataFrame, fraction: float = 0.8, entity_cols: list[str] = ["entity"],
                       period: str = "period",
                       segment_rows: int | None = SEGMENT_ROWS) -> DataFrame:
    """Add ``split``: the first ``int(fraction * n)`` rows of each entity are ``train``."""
    placed = with_position(df, entity_cols, period, segment_rows)
    first = F.floor(F.lit(float(fraction)) * F.col(TOTAL))
    return _drop_marks(placed.withColumn(
        "split", F.when(F.col(POS) <= first, "train").otherwise("test")
    )).select(*_keys(df.columns), "split")


def contiguous_folds(df: DataFrame, k: int = 5, entity_cols: list[str] = ["entity"],
                     period: str = "period", column: str = "fold",
                     segment_rows: int | None = SEGMENT_ROWS) -> DataFrame:
    """Add an unshuffled fold number; the first ``n mod k`` folds hold one row more."""
    if k < 2:
        raise ValueError("k must be at least 2")
    placed = with_position(df, entity_cols, period, segment_rows)
    base = F.floor(F.col(TOTAL) / F.lit(k))
    extra = F.pmod(F.col(TOTAL), F.lit(k))
    index = F.col(POS) - 1
    cut = extra * (base + 1)
    fold = F.when(index < cut, F.floor(index / (base + 1))).otherwise(
        extra + F.floor((index - cut) / F.greatest(base, F.lit(1)))
    )
    return _drop_marks(placed.withColumn(column, fold.cast("int"))).select(
        *_keys(df.columns), column
    )


def last_rows(df: DataFrame, entity_cols: list[str] = ["entity"],
              period: str = "period") -> DataFrame:
    """The latest row of each entity.

    The rank filter is applied before the shuffle too (window group limit), so
    each map task sends one row per entity.
    """
    w = Window.partitionBy(*_keys(entity_cols)).orderBy(col(period).desc())
    return df.withColumn("__rank", F.row_number().over(w)).filter("__rank = 1").drop("__rank")
