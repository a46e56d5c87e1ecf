"""Ordered computation without a single-partition window.

``Window.orderBy(...)`` with no partition key moves the whole table onto one
task.  The operators here keep an ordered stream distributed:

* :func:`ranged` - range-partition on the total order, sort inside each
  partition and tag every row with its block (= partition) ``_blk`` and its
  index in the block ``_idx``.  The result is checkpointed (reliable
  checkpoint dir), so a recomputation can never re-sample different range
  bounds: positions stay exact when executors are lost.
* :func:`with_position` - global 0-based position ``_pos`` = block offset +
  index; block offsets come from a per-block count (one row per block).
* :func:`running_aggs` - inclusive prefix sum / max / min: per-block
  partial aggregates, an exclusive scan over the block rows, broadcast
  carry-in, then a window partitioned by block.
* :func:`running_sum_max` - prefix sum plus the running maximum of the
  prefix sum (equity curves, drawdowns).
* :func:`halo_window` - bounded look-back frames (lags, rolling statistics)
  over fixed-size blocks of positions; the last ``halo`` rows of each block
  are copied into the next block as context and dropped after the window.

Only frames with one row per block ever run on a single partition; their
size is bounded by the number of blocks, not by the data.
"""

from __future__ import annotations

from typing import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

BLK, IDX, POS = "_blk", "_idx", "_pos"
_IDX_BITS = 33  # monotonically_increasing_id = partition << 33 | row-in-partition


def _cols(order: Sequence) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def default_blocks(df: DataFrame) -> int:
    """Number of range blocks: the shuffle-partition setting, which a job sizes to its input."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the cluster's checkpoint dir."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        from quantspark.session import prepare_session
        prepare_session(df.sparkSession)
    return df.checkpoint(eager=True)


def ranged(df: DataFrame, order: Sequence, num_blocks: int | None = None) -> DataFrame:
    """Range-partition by ``order``; add ``_blk`` (block) and ``_idx`` (row in block)."""
    n = num_blocks or default_blocks(df)
    oc = _cols(order)
    out = (df.repartitionByRange(n, *oc)
             .sortWithinPartitions(*oc)
             .withColumn("_mid", F.monotonically_increasing_id())
             .withColumn(BLK, F.shiftright("_mid", _IDX_BITS).cast("int"))
             .withColumn(IDX, F.col("_mid").bitwiseAND(F.lit((1 << _IDX_BITS) - 1)))
             .drop("_mid"))
    return materialize(out)


def _blocks(df: DataFrame, order: Sequence | None, num_blocks: int | None) -> DataFrame:
    if BLK in df.columns and IDX in df.columns:
        return df
    if order is None:
        raise ValueError("order is required for a frame without _blk/_idx")
    return ranged(df, order, num_blocks)


def _before(order_col: str) -> WindowSpec:
    # One row per block: a single-partition window here is bounded by the block count.
    return Window.orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)


def block_offsets(rng: DataFrame) -> DataFrame:
    """One row per non-empty block: (_blk, _n, _off) with _off = rows in earlier blocks."""
    counts = rng.groupBy(BLK).agg(F.count(F.lit(1)).alias("_n"))
    return counts.withColumn("_off", F.coalesce(F.sum("_n").over(_before(BLK)), F.lit(0)))


def with_position(df: DataFrame, order: Sequence | None = None, num_blocks: int | None = None,
                  keep_blocks: bool = False) -> DataFrame:
    """Add ``_pos``: the 0-based position of each row in ``order`` (a total order)."""
    rng = _blocks(df, order, num_blocks)
    offs = block_offsets(rng).select(BLK, "_off")
    out = (rng.join(F.broadcast(offs), BLK)
              .withColumn(POS, F.col("_off") + F.col(IDX)).drop("_off"))
    return out if keep_blocks else out.drop(BLK, IDX)


_KINDS = {"sum": (F.sum, lambda a, b: a + b), "max": (F.max, F.greatest), "min": (F.min, F.least)}


def running_aggs(df: DataFrame, aggs: dict[str, tuple[str, Column]], order: Sequence | None = None,
                 num_blocks: int | None = None, keep_blocks: bool = False) -> DataFrame:
    """Inclusive prefix aggregates ``{name: (kind, expr)}``, kind in sum/max/min.

    Sums treat NULL as 0 once a value was seen (the carry is 0 before any);
    max/min skip NULLs and accept any orderable type (e.g. a struct whose
    first field is a position gives 'last non-null value so far').
    """
    tmp = {f"_v{i}": e for i, (_, e) in enumerate(aggs.values())}
    kinds = [k for k, _ in aggs.values()]
    rng = _blocks(df, order, num_blocks).withColumns(tmp)
    tot = rng.groupBy(BLK).agg(*[_KINDS[k][0](c).alias(c + "_t") for c, k in zip(tmp, kinds)])
    carry = tot.select(BLK, *[_KINDS[k][0](c + "_t").over(_before(BLK)).alias(c + "_c")
                              for c, k in zip(tmp, kinds)])
    w = Window.partitionBy(BLK).orderBy(IDX).rowsBetween(Window.unboundedPreceding, 0)
    out = rng.join(F.broadcast(carry), BLK, "left")
    cols = {}
    for name, c, k in zip(aggs.keys(), tmp, kinds):
        local = _KINDS[k][0](c).over(w)
        if k == "sum":
            cols[name] = F.coalesce(F.col(c + "_c"), F.lit(0)) + F.coalesce(local, F.lit(0))
        else:
            cols[name] = _KINDS[k][1](F.col(c + "_c"), local)
    out = out.withColumns(cols).drop(*tmp, *[c + "_c" for c in tmp])
    return out if keep_blocks else out.drop(BLK, IDX)


def running_sums(df: DataFrame, order: Sequence, values: dict[str, Column],
                 num_blocks: int | None = None) -> DataFrame:
    return running_aggs(df, {k: ("sum", v) for k, v in values.items()}, order, num_blocks)


def running_sum_max(df: DataFrame, value: Column, order: Sequence | None = None,
                    cum: str = "cum", runmax: str = "runmax", num_blocks: int | None = None,
                    keep_blocks: bool = False) -> DataFrame:
    """Prefix sum ``cum`` and its running maximum ``runmax`` (which starts at the first cum).

    NULL values count as 0.  In-block windows give local prefix sums and
    their local running max; one row per block (sum, max local prefix) is
    scanned into (C_b, M_b); then cum = C_b + local and
    runmax = max(M_b, C_b + local running max).
    """
    rng = _blocks(df, order, num_blocks).withColumn("_v", F.coalesce(value, F.lit(0.0)))
    w = Window.partitionBy(BLK).orderBy(IDX).rowsBetween(Window.unboundedPreceding, 0)
    loc = rng.withColumn("_lc", F.sum("_v").over(w)).withColumn("_lm", F.max("_lc").over(w))
    st = loc.groupBy(BLK).agg(F.sum("_v").alias("_s"), F.max("_lc").alias("_mx"))
    carry = (st.withColumn("_C", F.coalesce(F.sum("_s").over(_before(BLK)), F.lit(0.0)))
               .withColumn("_M", F.max(F.col("_C") + F.col("_mx")).over(_before(BLK)))
               .select(BLK, "_C", "_M"))
    out = loc.join(F.broadcast(carry), BLK, "left")
    out = (out.withColumn(cum, F.col("_C") + F.col("_lc"))
              .withColumn(runmax, F.greatest(F.col("_M"), F.col("_C") + F.col("_lm")))
              .drop("_v", "_lc", "_lm", "_C", "_M"))
    return out if keep_blocks else out.drop(BLK, IDX)


def halo_window(df: DataFrame, halo: int, build: Callable[[WindowSpec], dict[str, Column]],
                order: Sequence | None = None, group: Iterable[str] = (),
                block_rows: int = 1 << 16, num_blocks: int | None = None) -> DataFrame:
    """Evaluate look-back window expressions whose frames reach ``halo`` rows back.

    ``build(w)`` receives ``Window.partitionBy(block, *group).orderBy(_pos)``
    and returns {column: expression}; frames must stay within ``halo`` rows
    back and must not look forward.  Rows are placed in blocks of
    ``block_rows`` consecutive positions of the total order (group, order),
    so one hot group is split over many blocks; each block also receives the
    ``halo`` rows before it as context rows, removed after the window.
    If ``df`` already has ``_pos`` (from :func:`with_position` on
    (group, order)), it is used as is and kept.
    """
    group = list(group)
    B = max(int(block_rows), int(halo), 1)
    had_pos = POS in df.columns
    pos_df = df if had_pos else with_position(df, [*group, *order], num_blocks)
    hb = F.floor(F.col(POS) / B)
    copies = F.when((F.col(POS) % B) >= B - halo, F.array(hb, hb + 1)).otherwise(F.array(hb))
    x = (pos_df.withColumn("_hb0", hb)
               .withColumn("_hb", F.explode(copies))
               .withColumn("_ctx", F.col("_hb") != F.col("_hb0")))
    w = Window.partitionBy("_hb", *group).orderBy(POS)
    out = x.withColumns(build(w)).filter(~F.col("_ctx")).drop("_hb0", "_hb", "_ctx")
    return out if had_pos else out.drop(POS)


def exact_median(df: DataFrame, col, num_blocks: int | None = None) -> DataFrame:
    """Exact median of a numeric column (average of the two middle values for an even count)
    as a one-row DataFrame ``median``.  Distributed: the values are range-partitioned and
    positioned; only the (at most two) middle rows are kept -- no single buffer of all values."""
    c = F.col(col) if isinstance(col, str) else col
    vals = df.select(c.cast("double").alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    # A row id breaks ties, so a value shared by a large share of the rows is still
    # split over several range blocks (the ranged frame is checkpointed).
    vals = vals.withColumn("_t", F.monotonically_increasing_id())
    pos = with_position(vals, ["_v", "_t"], num_blocks, keep_blocks=True)
    n = block_offsets(pos).agg(F.sum("_n").alias("_cnt"))
    mid = (pos.join(F.broadcast(n), how="inner", on=F.lit(True))  # one-row frame
              .filter((F.col(POS) == F.floor((F.col("_cnt") - 1) / 2)) | (F.col(POS) == F.floor(F.col("_cnt") / 2))))
    return mid.agg(F.avg("_v").alias("median"))
