"""Order-dependent time-series operators that never put a whole series in one task.

The reference treats each feed as one ordered series and uses positional
operators on it (``shift``, ``rolling``, ``interpolate``, ``tail``, sliding
windows).  A plain ``Window.partitionBy(series)`` would give each series one
task; one series may hold a large share of all rows, so every operator here
works on *blocks* instead:

1. ``with_position``: a global 0-based position per series.  Rows are counted
   per (series, coarse time bucket); a running sum over that small count table
   gives each bucket's offset; the offsets are joined back (AQE broadcasts them only
   when their materialised size is under its threshold) and ``row_number`` inside the bucket completes the position.
2. ``blocked``: ``block = pos div B``; the last ``halo`` rows of each block are
   copied into the next block, windows run per (series, block), and the copies
   are dropped afterwards.  Lags up to ``halo`` and frames reaching ``halo`` rows
   back are then exact, with ``halo / B`` extra rows shuffled.
3. Unbounded look-back/look-ahead (interpolation) carries one summary row per
   block, in two levels (blocks within super-blocks of ``fanout`` blocks, then
   super-blocks along the series), so no carry window holds more than a bounded
   share of a long series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airshed.operators.joins import join_derived_small

POS = "_pos"
BLK = "_blk"
HALO = "_halo"
DEFAULT_BLOCK_ROWS = 512


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x or [])


def with_position(df: DataFrame, series, order, bucket: Column | None = None) -> DataFrame:
    """Add ``_pos``: 0-based row position within each series in ``order``.

    ``bucket`` groups rows into ordered chunks (default: the day of the first order
    column); it must be monotone in ``order`` and should bound the rows per bucket.
    ``order`` must be unique within a series (add a tie-breaker column otherwise).
    """
    series, order = _cols(series), _cols(order)
    bucket = bucket if bucket is not None else F.date_trunc("day", F.col(order[0]))
    d = df.withColumn("_bkt", bucket)
    counts = d.groupBy(*series, "_bkt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*series).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*series, "_bkt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    # number rows inside each bucket first (the one shuffle of the rows), then add the bucket's
    # offset: the rows are already partitioned by the join key, only the small side moves
    rn = F.row_number().over(Window.partitionBy(*series, "_bkt").orderBy(*order))
    d = join_derived_small(d.withColumn("_rn", rn), offsets, series + ["_bkt"], "inner")
    return d.withColumn(POS, (F.col("_off") + F.col("_rn") - 1).cast("long")).drop("_bkt", "_off", "_rn")


def series_sizes(df: DataFrame, series) -> DataFrame:
    """Rows per series (one small row per series)."""
    series = _cols(series)
    return df.groupBy(*series).agg(F.count(F.lit(1)).alias("_size"))


def with_size(df: DataFrame, series) -> DataFrame:
    """Attach ``_size`` (rows in the row's series): an equi-join with one row per series, which Spark
    broadcasts if its measured size is under the threshold and splits where a series is large."""
    series = _cols(series)
    if not series:
        raise ValueError("series key required")
    return join_derived_small(df, series_sizes(df, series), series, "inner")


def blocked(df: DataFrame, halo: int, block_rows: int = DEFAULT_BLOCK_ROWS, ahead: int = 0) -> DataFrame:
    """Assign blocks; copy the last ``halo`` rows of each block into the next one and the
    first ``ahead`` rows into the previous one (look-back and look-ahead halos).

    A block holds ``block_rows`` rows, or four halos if a halo would not fit: any lag or window works.
    """
    block_rows = block_rows if max(halo, ahead) <= block_rows else 4 * max(halo, ahead)
    home = F.floor(F.col(POS) / F.lit(block_rows)).cast("long")
    off = F.col(POS) % F.lit(block_rows)
    nxt = F.when(F.lit(halo > 0) & (off >= F.lit(block_rows - halo)), home + 1)
    prv = F.when(F.lit(ahead > 0) & (off < F.lit(ahead)) & (home > 0), home - 1)
    copies = F.array_compact(F.array(home, nxt, prv))
    return (df.withColumn("_home", home).withColumn(BLK, F.explode(copies))
            .withColumn(HALO, F.col(BLK) != F.col("_home")).drop("_home"))


def unblock(df: DataFrame) -> DataFrame:
    return df.where(~F.col(HALO)).drop(BLK, HALO)


def block_window(series) -> Window:
    return Window.partitionBy(*_cols(series), BLK).orderBy(POS)


def add_lags(df: DataFrame, series, col: str, lags: dict[str, int],
             block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Positional lags ``{name: k}`` of ``col`` (requires ``_pos``)."""
    halo = max(lags.values())
    w = block_window(series)
    d = blocked(df, halo, block_rows)
    d = d.select("*", *[F.lag(col, k).over(w).alias(name) for name, k in lags.items()])
    return unblock(d)


def add_leads(df: DataFrame, series, col: str, leads: dict[str, int],
              block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Positional leads ``{name: k}`` of ``col`` (the next rows' values), blocked."""
    w = block_window(series)
    d = blocked(df, 0, block_rows, ahead=max(leads.values()))
    d = d.select("*", *[F.lead(col, k).over(w).alias(name) for name, k in leads.items()])
    return unblock(d)


def _with_next(df: DataFrame, series, t: str, block_rows: int) -> DataFrame:
    """``_next``: the time of the series' next row (by position, so no task holds a whole series)."""
    d = with_position(df, series, [t])
    return add_leads(d, series, t, {"_next": 1}, block_rows).drop(POS)


def hourly_gaps(df: DataFrame, series, t: str = "datetime", block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """The gaps of each hourly series: ``gap_start`` and ``gap_end`` (first and last missing hour) and ``hours``."""
    series, hour = _cols(series), F.expr("INTERVAL 1 HOUR")
    d = _with_next(df.select(*series, t), series, t, block_rows)
    hours = F.floor((F.unix_seconds(F.col("_next").cast("timestamp")) - F.unix_seconds(F.col(t).cast("timestamp"))) / 3600) - 1
    return (d.withColumn("hours", hours.cast("long")).where(F.col("hours") > 0)
            .select(*series, (F.col(t) + hour).alias("gap_start"), (F.col("_next") - hour).alias("gap_end"), "hours"))


def hourly_spine(df: DataFrame, series, t: str = "datetime", block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """``df`` with a row for every hour between each series' first and last; ``filled`` marks the new rows, whose other
    columns are null.

    Each row brings forth the hours up to the next one, so only gaps are made, and nothing is joined.
    On such a series lags and windows by position are lags and windows by the clock.
    """
    series, hour = _cols(series), F.expr("INTERVAL 1 HOUR")
    rest = [c for c in df.columns if c not in [*series, t]]
    d = _with_next(df, series, t, block_rows)
    missing = F.when(F.col("_next") > F.col(t) + hour, F.sequence(F.col(t) + hour, F.col("_next") - hour, hour))
    own = F.col(t).cast("timestamp_ntz")
    d = d.select(*series, *rest, F.posexplode(F.concat(F.array(own), F.coalesce(missing, F.array().cast("array<timestamp_ntz>")))).alias("_n", t))
    return d.select(*[F.when(F.col("_n") == 0, F.col(c)).alias(c) if c in rest else F.col(c) for c in df.columns], (F.col("_n") > 0).alias("filled"))


def add_rolling_means(df: DataFrame, series, col: str, windows: dict[str, int],
                      block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Trailing mean over ``n`` rows including the current one; NULL unless the window is
    full and free of NULLs (pandas ``rolling(n).mean()``)."""
    halo = max(windows.values()) - 1
    w = block_window(series)
    d = blocked(df, halo, block_rows)
    outs = []
    for name, n in windows.items():
        f = w.rowsBetween(-(n - 1), 0)
        outs.append(F.when(F.count(col).over(f) == n, F.avg(col).over(f)).alias(name))
    return unblock(d.select("*", *outs))


def add_window_features(df: DataFrame, series, col: str, lags: dict[str, int],
                        windows: dict[str, int], block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """E1 + E2 in one blocked pass (one shuffle, one sort): lags and full rolling means."""
    halo = max(list(lags.values()) + [n - 1 for n in windows.values()])
    w = block_window(series)
    d = blocked(df, halo, block_rows)
    outs = [F.lag(col, k).over(w).alias(name) for name, k in lags.items()]
    for name, n in windows.items():
        f = w.rowsBetween(-(n - 1), 0)
        outs.append(F.when(F.count(col).over(f) == n, F.avg(col).over(f)).alias(name))
    return unblock(d.select("*", *outs))


def add_sequences(df: DataFrame, series, features: list[str], target: str, window: int,
                  out: str = "sequence", block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """For each row, the feature vectors of the ``window`` previous rows (oldest first);
    rows without a full history are dropped.  The current row's ``target`` is the label."""
    w = block_window(series).rowsBetween(-window, -1)
    d = blocked(df, window, block_rows)
    vec = F.array(*[F.col(c).cast("double") for c in features])
    d = d.select("*", F.collect_list(vec).over(w).alias(out))
    d = unblock(d).where(F.size(out) == window)
    return d.select(*_cols(series), POS, out, F.col(target).alias("label"))


def _carry_in_out(summary: DataFrame, series: list[str], n: int, fanout: int) -> DataFrame:
    """Per block: the last valid (pos, value) strictly before it (``_cin_i``) and the first
    valid strictly after it (``_cout_i``), from one summary row per block.

    Two levels, so no window sees more than ``fanout`` rows of one series per task-sized
    partition: blocks are grouped into super-blocks of ``fanout`` blocks; the super-block
    summaries are carried across along the series (rows / (block * fanout) rows), the
    blocks inside each super-block, and the nearer of the two wins.
    """
    sb = F.floor(F.col(BLK) / F.lit(fanout)).cast("long")
    s = summary.withColumn("_sb", sb)
    sup = s.groupBy(*series, "_sb").agg(
        *[F.max(f"_last_{i}").alias(f"_sl_{i}") for i in range(n)],
        *[F.min(f"_first_{i}").alias(f"_sf_{i}") for i in range(n)])
    # running frames only: "the first after" is the last before, in descending order
    ws, ws_down = (Window.partitionBy(*series).orderBy(o).rowsBetween(Window.unboundedPreceding, -1) for o in (F.asc("_sb"), F.desc("_sb")))
    sup = sup.select(
        *series, "_sb",
        *[F.last(f"_sl_{i}", ignorenulls=True).over(ws).alias(f"_sin_{i}") for i in range(n)],
        *[F.last(f"_sf_{i}", ignorenulls=True).over(ws_down).alias(f"_sout_{i}") for i in range(n)])
    wb, wb_down = (Window.partitionBy(*series, "_sb").orderBy(o).rowsBetween(Window.unboundedPreceding, -1) for o in (F.asc(BLK), F.desc(BLK)))
    inner = s.select(
        *series, "_sb", BLK,
        *[F.last(f"_last_{i}", ignorenulls=True).over(wb).alias(f"_bin_{i}") for i in range(n)],
        *[F.last(f"_first_{i}", ignorenulls=True).over(wb_down).alias(f"_bout_{i}") for i in range(n)])
    both = join_derived_small(inner, sup, series + ["_sb"], "inner")
    return both.select(
        *series, BLK,
        *[F.coalesce(f"_bin_{i}", f"_sin_{i}").alias(f"_cin_{i}") for i in range(n)],
        *[F.coalesce(f"_bout_{i}", f"_sout_{i}").alias(f"_cout_{i}") for i in range(n)])


def interpolate_linear(df: DataFrame, series, cols: list[str], limit: int = 3,
                       block_rows: int = DEFAULT_BLOCK_ROWS, fanout: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Pandas ``interpolate(method="linear", limit=limit)`` by position.

    A NULL at position i with previous valid (p, a) and next valid (q, b) becomes
    ``(b - a) / (q - p) * (i - p) + a`` if ``i - p <= limit``; trailing NULLs take ``a``
    (same limit); leading NULLs and the rest of long gaps stay NULL.  Index spacing is
    ignored, as in the reference.
    """
    series = _cols(series)
    d = df.withColumn(BLK, F.floor(F.col(POS) / F.lit(block_rows)).cast("long"))

    def valid(c):
        return F.when(F.col(c).isNotNull(), F.struct(F.col(POS).alias("p"), F.col(c).cast("double").alias("v")))

    # one summary row per block: last and first valid (pos, value) of every column
    summary = d.groupBy(*series, BLK).agg(
        *[F.max(valid(c)).alias(f"_last_{i}") for i, c in enumerate(cols)],
        *[F.min(valid(c)).alias(f"_first_{i}") for i, c in enumerate(cols)])
    carry = _carry_in_out(summary, series, len(cols), fanout)

    # within-block nearest valid values first (the one shuffle of the rows, on (series, block)),
    # then the small carry table joins on the same key.  Running frames only: the look-ahead is
    # a running ``last`` in descending order, so both passes are O(n log n) per block (an
    # unbounded-following frame would be O(n^2))
    back = Window.partitionBy(*series, BLK).orderBy(POS).rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*series, BLK).orderBy(F.col(POS).desc()).rowsBetween(Window.unboundedPreceding, 0)
    d = d.select("*", *[F.last(valid(c), ignorenulls=True).over(back).alias(f"_pv_{i}") for i, c in enumerate(cols)])
    d = d.select("*", *[F.last(valid(c), ignorenulls=True).over(ahead).alias(f"_nv_{i}") for i, c in enumerate(cols)])
    d = join_derived_small(d, carry, series + [BLK], "inner")
    outs = []
    for i, c in enumerate(cols):
        prev = F.coalesce(F.col(f"_pv_{i}"), F.col(f"_cin_{i}"))
        nxt = F.coalesce(F.col(f"_nv_{i}"), F.col(f"_cout_{i}"))
        gap = (F.col(POS) - prev["p"]).cast("double")
        slope = (nxt["v"] - prev["v"]) / (nxt["p"] - prev["p"]).cast("double")
        filled = (F.when(F.col(c).isNotNull(), F.col(c).cast("double"))
                  .when(prev.isNull(), F.lit(None).cast("double"))
                  .when(F.col(POS) - prev["p"] > limit, F.lit(None).cast("double"))
                  .when(nxt.isNull(), prev["v"])
                  .otherwise(slope * gap + prev["v"]))
        outs.append(filled.alias(c))
    keep = [c for c in df.columns if c not in cols]
    return d.select(*keep, *outs).select(*df.columns)


def last_n(df: DataFrame, series, n: int) -> DataFrame:
    """E5: the last ``n`` rows of each series by position (``tail(n)``); needs ``_pos``."""
    d = with_size(df, series)
    return d.where(F.col(POS) >= F.col("_size") - n).drop("_size")


def first_n(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows of each series by position (``head(n)``); needs ``_pos``."""
    return df.where(F.col(POS) < n)


def chrono_split(df: DataFrame, series, train_share: float = 0.8, rule: str = "floor") -> DataFrame:
    """Positional chronological split, column ``split`` in {train, test}.

    ``rule="floor"``: the first ``floor(share * n)`` rows train (LSTM/Prophet scripts);
    ``rule="test_ceil"``: the last ``ceil((1 - share) * n)`` rows test (XGBoost script's splitter).
    """
    d = with_size(df, series)
    n = F.col("_size")
    if rule == "floor":
        n_train = F.floor(n * F.lit(train_share))
    else:
        n_train = n - F.ceil(n * F.lit(round(1.0 - train_share, 12)))
    return d.withColumn("split", F.when(F.col(POS) < n_train, F.lit("train")).otherwise(F.lit("test"))).drop("_size")


def add_time_lags(df: DataFrame, series, t: str, col: str, lags: dict[str, int]) -> DataFrame:
    """E1, ``mode="time"``: the value of ``col`` exactly ``k`` hours earlier (NULL when that
    hour has no row), for ``lags = {name: k}``; ``(series, t)`` must be unique.

    No window and no position: every row is copied once per lag to the time it is a lag
    *for*, the copies are folded to one row per target (series, time) and equi-joined back.
    The key contains the time, so one series holding a third of all rows is still spread
    over every task, and the fan-out is the fixed number of lags.
    """
    series = _cols(series)
    shifts = F.array(*[F.struct(F.lit(name).alias("_lag"),
                                (F.col(t) + F.make_dt_interval(F.lit(0), F.lit(k))).alias("_t"))
                       for name, k in lags.items()])
    copies = (df.select(*series, F.col(col).alias("_v"), F.explode(shifts).alias("_s"))
              .select(*series, F.col("_s._t").alias(t), F.col("_s._lag").alias("_lag"), "_v"))
    wide = copies.groupBy(*series, t).agg(
        *[F.max(F.when(F.col("_lag") == name, F.col("_v"))).alias(name) for name in lags])
    return df.join(wide, series + [t], "left")
