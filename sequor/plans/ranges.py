"""Range plan: rows numbered and windowed without grouping a series into one task.

Rows move once. ``repartitionByRange`` samples split points on the full composite
key (series, every order column, then a hash of the other columns) and deals
the rows to ranges of about equal size; any sortable type will do, NULLs come
first, NaN last, equal times are split by the columns that break the tie. Only
rows equal in every column stay together. Each range is sorted and written once
to the shared scratch folder, so later passes and retries see the same ranges.

A range is the work of one task. Where ranges of the size asked for would be many and
small, a task takes TASK_ROWS rows instead: the number of tasks stays in proportion to the rows.

A *piece* is the part of a series inside a range; to number rows it is cut again where it
holds more rows than asked for. Exact counts per piece (one narrow row each) give the
offsets of a running number (:func:`number_ranges`).

For windows (:func:`range_windows`) a task turns its sorted range into *blocks*:
one row per (piece, block) holding one array per column, its anchors plus the
rows of the same piece that their windows reach. Windows are slices of those
arrays by index, in the task that reads the block. Only the first ``past - 1``
anchors of a piece reach back over its start and only the last ``shift + future - 1``
over its end. For these the boundary rows of both pieces move, by a small second
exchange, and take the plain window plan.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import windows as W
from ..params import SequenceSpec
from ..session import written
from . import numbering as NB

PLACE = "_sq_place"
PID = "_sq_pid"
TIE = "_sq_tie"
ORDINAL = "_sq_k"
LAST_ORDINAL = "_sq_kn"
COUNT = "_sq_c"
#: Ranges per ``rows_per_range`` rows: sampled split points vary, so ranges are cut smaller than allowed.
OVERSPLIT = 1.5
#: Tasks of fewer rows than TASK_ROWS are made up to FEW_TASKS only: each one costs the driver its result and
#: status and every writer a shuffle block.
TASK_ROWS = 100_000
FEW_TASKS = 64


def range_count(rows: int, rows_per_range: int) -> int:
    """Tasks for ``rows`` rows: ranges of at most about ``rows_per_range`` rows each, or of TASK_ROWS where that
    would make many small ones."""
    wanted = max(1, int(-(-rows * OVERSPLIT // rows_per_range)))
    return min(wanted, max(FEW_TASKS, int(-(-rows * OVERSPLIT // TASK_ROWS))))


def _hashable(dt: T.DataType) -> bool:
    if isinstance(dt, T.StructType):
        return all(_hashable(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return _hashable(dt.elementType)
    return not isinstance(dt, (T.MapType, T.VariantType))


def range_sorted(df: DataFrame, series: Sequence[str], order: Sequence[str], ranges: int) -> DataFrame:
    """``df`` dealt to ``ranges`` sorted ranges of the full order: one exchange of the rows."""
    keys = [*series, *[c for c in order if c not in series]]
    others = [c for c in df.columns if c not in keys and _hashable(df.schema[c].dataType)]
    tied = df.withColumn(TIE, F.xxhash64(*others) if others else F.lit(0))
    by = [F.col(c).asc_nulls_first() for c in keys] + [F.col(TIE).asc()]
    return tied.repartitionByRange(ranges, *by).sortWithinPartitions(*by).drop(TIE)


def with_offsets(pieces: DataFrame, series: Sequence[str]) -> DataFrame:
    """Pieces ``(series..., pid, count)`` with the rows of the series before them, its size, and their ordinal.

    One narrow row per piece: at most rows / rows_per_range plus the number of series."""
    w = Window.partitionBy(*series).orderBy(PID)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return pieces.select(
        "*",
        F.coalesce(F.sum(COUNT).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long").alias(NB.OFFSET),
        F.sum(COUNT).over(whole).cast("long").alias(NB.N_),
        F.row_number().over(w).alias(ORDINAL),
        F.count(F.lit(1)).over(whole).cast("int").alias(LAST_ORDINAL),
    )


def located(counted: DataFrame, series: Sequence[str]) -> tuple[DataFrame, list | None]:
    """:func:`with_offsets` of the pieces: as a local table, and its rows, when there are at most
    ``MAX_BROADCAST_HOT`` (the driver adds up their counts), else as a plan and None."""
    rows = counted.limit(NB.MAX_BROADCAST_HOT + 1).collect()
    if len(rows) > NB.MAX_BROADCAST_HOT:
        return with_offsets(counted, series), None
    groups: dict[tuple, list] = {}
    for r in sorted(rows, key=lambda r: r[PID]):
        groups.setdefault(tuple("NaN" if r[c] != r[c] else r[c] for c in series), []).append(r)
    out = []
    for own in groups.values():
        whole, before = sum(r[COUNT] for r in own), 0
        for k, r in enumerate(own, 1):
            out.append((*r, before, whole, k, len(own)))
            before += r[COUNT]
    fields = [T.StructField(NB.OFFSET, T.LongType()), T.StructField(NB.N_, T.LongType()), T.StructField(ORDINAL, T.IntegerType()), T.StructField(LAST_ORDINAL, T.IntegerType())]
    kind = T.StructType([*counted.schema.fields, *fields])
    return counted.sparkSession.createDataFrame(out, kind), [Row(*kind.names)(*r) for r in out]


def placed_rows(df: DataFrame, series: Sequence[str], order: Sequence[str], rows_per_range: int, rows: int | None = None) -> DataFrame:
    """``df`` written in ranges; ``_sq_place`` is 2^33 x range + position in it."""
    if rows_per_range < 1:
        raise ValueError("rows per range must be >= 1")
    ranges = range_count(df.count() if rows is None else rows, rows_per_range)
    moved = range_sorted(df, series, order, ranges)
    return written(moved.withColumn(PLACE, F.monotonically_increasing_id()), "ranges")


def number_ranges(df: DataFrame, series: Sequence[str], order: Sequence[str], rows_per_range: int,
                  rn: str = "rn", n: str = "n", rows: int | None = None) -> DataFrame:
    """Add the 1-based row number in the series and the series size.

    ``rows`` is the number of rows where it is known, which saves a count. A piece is what a series has
    of ``rows_per_range`` places of a task, so it holds no more rows than that, however many the task has.
    Beyond ``MAX_BROADCAST_HOT`` pieces their offsets are joined by shuffle."""
    placed = placed_rows(df, series, order, rows_per_range, rows)
    placed = placed.withColumn(PID, F.col(PLACE) - F.col(PLACE).bitwiseAND((1 << 33) - 1) % rows_per_range)
    pieces = placed.groupBy(*series, PID).agg(F.count(F.lit(1)).alias(COUNT), F.min(PLACE).alias("_sq_first"))
    pieces, known = located(pieces, series)
    out = NB.join_on(placed, pieces.drop(ORDINAL, LAST_ORDINAL, COUNT), [*series, PID], "inner", broadcast=known is not None)
    out = out.withColumn(rn, F.col(NB.OFFSET) + F.col(PLACE) - F.col("_sq_first") + 1).withColumn(n, F.col(NB.N_))
    return out.select(*df.columns, rn, n)


# --- blocks of arrays ---------------------------------------------------------


def _changes(column: pa.Array) -> np.ndarray:
    """Where a row's value differs from the one before (NULL equals NULL, NaN equals NaN)."""
    a, b = column.slice(0, len(column) - 1), column.slice(1)
    differ = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False)
    if pa.types.is_floating(column.type):
        differ &= ~(pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False).to_numpy(zero_copy_only=False))
    return differ | (a.is_null().to_numpy(zero_copy_only=False) != b.is_null().to_numpy(zero_copy_only=False))


def cut_blocks(lengths_open: tuple[int, int, int, bool], block: int, past: int, ahead: int) -> tuple[list[tuple], int]:
    """Blocks of the rows ``lo..hi`` of a piece of which ``a`` is the first row without a block yet.

    Returns ``(first row, rows before, own rows, rows after, ends the piece)`` per block, and the next ``a``. Every
    block but a last one has ``block`` anchors and leaves enough rows for its windows."""
    lo, hi, a, closed = lengths_open
    reach = past - 1 + ahead
    out = []
    while a < hi:
        last = hi - a < block + reach
        if last and not closed:
            break
        own = hi - a if last else block
        before = min(a - lo, past - 1)
        out.append((a - before, before, own, 0 if last else ahead, last))
        a += own
    return out, a


def block_arrays(df: DataFrame, spec: SequenceSpec, ranges: int, block: int) -> DataFrame:
    """The block table of ``df``, written once.

    Columns: ``_s<i>`` series keys, ``_sq_pid``, ``start`` (of its first anchor in the piece),
    ``own``, ``before``, ``first``, ``last`` (of the piece), ``_v<j>`` one array per value column,
    ``zp`` / ``zl`` running counts of rows with a NULL feature / label."""
    values = value_columns(spec)
    cols = {name: (F.col(name) if kind == "key" else W._elem(spec, name)) for kind, name in values}
    keys = list(dict.fromkeys([*spec.series, *spec.order, *spec.features, spec.label]))
    moved = range_sorted(df.select(*keys), spec.series, spec.order, ranges)
    n_series, n_values = len(spec.series), len(values)
    bad = F.lit(False)
    for f in spec.features:
        bad = bad | F.col(f).isNull()
    flat = moved.select(*[F.col(c).alias(f"_s{i}") for i, c in enumerate(spec.series)],
                        *[cols[name].alias(f"_v{j}") for j, (_, name) in enumerate(values)],
                        F.spark_partition_id().alias(PID), bad.cast("int").alias("zp"), F.col(spec.label).isNull().cast("int").alias("zl"))
    numbers = [T.StructField(c, T.IntegerType()) for c in (PID,)] + [T.StructField("start", T.LongType())]
    numbers += [T.StructField(c, T.IntegerType()) for c in ("own", "before")] + [T.StructField(c, T.BooleanType()) for c in ("first", "last")]
    arrays = [T.StructField(f"_v{j}", T.ArrayType(flat.schema[f"_v{j}"].dataType)) for j in range(n_values)]
    counts = [T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("zp", "zl")]
    schema = T.StructType([flat.schema[f"_s{i}"] for i in range(n_series)] + numbers + arrays + counts)
    past, ahead = spec.past, spec.shift + spec.future - 1

    def regroup(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, before, start = None, 0, 0  # rows of the open piece: windows reach the first ``before`` ones, the others have no block yet

        def out(t: pa.RecordBatch, found: list[tuple]) -> pa.RecordBatch:
            ends = np.r_[0, np.cumsum([b[1] + b[2] + b[3] for b in found])].astype(np.int32)
            spans = [(b[0], b[1] + b[2] + b[3]) for b in found]
            at = pa.array([b[0] + b[1] for b in found])
            columns = [t.column(f"_s{i}").take(at) for i in range(n_series)] + [t.column(PID).take(at)]
            columns += [pa.array([b[5] for b in found], pa.int64()), pa.array([b[2] for b in found], pa.int32()), pa.array([b[1] for b in found], pa.int32())]
            columns += [pa.array([b[5] == 0 for b in found]), pa.array([b[4] for b in found])]
            for j in range(n_values):
                v = t.column(f"_v{j}")
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.concat_arrays([v.slice(a, m) for a, m in spans])))
            for c in ("zp", "zl"):
                z = t.column(c).to_numpy()
                sums = [np.r_[0, np.cumsum(z[a:a + m])] for a, m in spans]
                columns.append(pa.ListArray.from_arrays(pa.array(ends + np.arange(len(ends), dtype=np.int32)), pa.array(np.concatenate(sums).astype(np.int32))))
            return pa.RecordBatch.from_arrays(columns, names=schema.names)

        for batch in _with_end(batches):
            if batch is None:
                t, bounds = held, [0, held.num_rows] if held is not None else []
            else:
                t = batch if held is None else pa.concat_batches([held, batch])
                differ = np.zeros(t.num_rows - 1, bool)
                for i in range(n_series):
                    differ |= _changes(t.column(f"_s{i}"))
                bounds = [0, *(np.flatnonzero(differ) + 1).tolist(), t.num_rows]
            found = []
            for lo, hi in zip(bounds, bounds[1:], strict=False):
                if lo:
                    before, start = 0, 0
                got, a = cut_blocks((lo, hi, lo + before, hi < t.num_rows or batch is None), block, past, ahead)
                for b in got:
                    found.append((*b, start))
                    start += b[2]
                if hi == t.num_rows:
                    held = t.slice(max(lo, a - (past - 1)))
                    before = a - max(lo, a - (past - 1))
            if found:
                yield out(t, found)

    return written(flat.mapInArrow(regroup, schema), "blocks")


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    """The batches that hold rows, then None."""
    for b in batches:
        if b.num_rows:
            yield b
    yield None


def value_columns(spec: SequenceSpec) -> list[tuple[str, str]]:
    """The arrays of a block: order columns as they are, then features and label as windows hold them."""
    keys = [("key", c) for c in spec.order if c not in spec.series]
    return keys + [("value", c) for c in dict.fromkeys([*spec.features, spec.label])]


def border_windows(blocks: DataFrame, spec: SequenceSpec, keys: list[str], trim: bool, observation=None) -> DataFrame:
    """The windows that reach over the boundary of two pieces, from the rows beside it alone."""
    back, ahead = spec.past - 1, spec.shift + spec.future - 1
    values = [f"_v{j}" for j in range(len(value_columns(spec)))]
    held = F.size("_v0")
    near = F.least(held, F.lit(back + ahead))
    first_rn = F.col(NB.OFFSET) + F.col("start") - F.col("before") + 1  # of the first row in the arrays

    def side(flag: Column, first: Column, boundary: Column, border: Column) -> Column:
        rows = F.arrays_zip(*[F.slice(c, first, near).alias(c) for c in values])
        return F.when(flag, F.struct(boundary.alias("boundary"), (first_rn + first - 1).alias("rn0"), border.alias("border"), rows.alias("rows")))

    # of what comes after a boundary the first ``back`` rows are anchors here, of what comes before it the last ``ahead``
    after = side(F.col("first") & (F.col(ORDINAL) > 1), F.lit(1), F.col(ORDINAL), F.lit(back))
    before = side(F.col("last") & (F.col(ORDINAL) < F.col(LAST_ORDINAL)), held - near + 1, F.col(ORDINAL) + 1, near - F.lit(ahead))
    sides = blocks.filter("first or last").select(*keys, NB.N_, ORDINAL, F.explode(F.array_compact(F.array(after, before))).alias("e"))
    rows = sides.select(*keys, F.col(NB.N_).alias(W.N), "e.boundary", "e.rn0", (F.col("e.boundary") == F.col(ORDINAL)).alias("later"), "e.border",
                        F.posexplode("e.rows").alias("at", "r"))
    anchor = F.when(F.col("later"), F.col("at") < F.col("border")).otherwise(F.col("at") >= F.col("border"))
    named = {name: f"_v{j}" for j, (_, name) in enumerate(value_columns(spec))}
    rows = rows.select(*[F.col(k).alias(c) for k, c in zip(keys, spec.series)], W.N, "boundary", (F.col("rn0") + F.col("at")).alias(W.RN),
                       anchor.alias("anchor"), *[F.col(f"r.{v}").alias(c) for c, v in named.items() if c not in spec.series])
    w = Window.partitionBy(*spec.series, "boundary").orderBy(W.RN)
    exprs = W.window_expressions(spec.with_(nested=False), w)  # the values are in their final layout
    windows = rows.select(*[c for c in rows.columns if c not in spec.features],
                          *[e.alias(c) for c, e in exprs.items() if c not in (W.RN, W.N)]).filter("anchor")
    if observation is not None:
        windows = windows.observe(observation, *W.anchor_metrics(windows, spec))
    trimmed = W.apply_trims(windows, spec, trim=trim)
    return trimmed.select(*W.output_columns(trimmed, spec))


def anchor_span(blocks: DataFrame, spec: SequenceSpec, trim: bool) -> DataFrame:
    """``blocks`` with ``_lo`` and ``_hi``, the first and last anchor (counted from the block's first) whose windows end
    inside the piece and, if ``trim``, inside the series; blocks without one go."""
    past, future, shift = spec.past, spec.future, spec.shift
    first_rn = F.col(NB.OFFSET) + F.col("start") + 1
    lo = F.when(F.col("first") & (F.col(ORDINAL) > 1), F.lit(past - 1)).otherwise(F.lit(0)).cast("long")
    over = F.when(F.col("last") & (F.col(ORDINAL) < F.col(LAST_ORDINAL)), F.lit(shift + future - 1)).otherwise(F.lit(0))
    hi = F.col("own").cast("long") - 1 - over
    if trim:
        lo = F.greatest(lo, F.lit(past) - first_rn)
        hi = F.least(hi, F.col(NB.N_) - F.lit(future + shift - 1) - first_rn)
        lo = lo + F.pmod(F.lit(past) - (first_rn + lo), F.lit(spec.step))
    return blocks.withColumns({"_lo": lo, "_hi": hi}).filter("_lo <= _hi")


def _span_metrics(spec: SequenceSpec) -> list[Column]:
    """A6 metrics from the spans of blocks, without making their anchors."""
    past, future, shift = spec.past, spec.future, spec.shift
    anchors = F.sequence("_lo", "_hi", F.lit(spec.step).cast("long"))

    def short(i: Column) -> Column:
        at = F.col("before") + i.cast("int")
        return (F.get("zp", at + 1) > F.get("zp", at - (past - 1))) | (F.get("zl", at + shift + future) > F.get("zl", at + shift))

    has = (F.element_at("zp", -1) > 0) | (F.element_at("zl", -1) > 0)
    return [F.sum(F.size(anchors)).alias("anchors_in_range"),
            F.sum(F.when(has, F.size(F.filter(anchors, short))).otherwise(F.lit(0))).alias("anchors_with_null")]


def _slices(blocks: DataFrame, spec: SequenceSpec, trim: bool, observation=None) -> DataFrame:
    """The anchors of :func:`anchor_span` with their windows, cut from the block's arrays by index."""
    past, future, shift = spec.past, spec.future, spec.shift
    first_rn = F.col(NB.OFFSET) + F.col("start") + 1
    some = anchor_span(blocks, spec, trim)
    if observation is not None:
        some = some.observe(observation, *_span_metrics(spec))
    some = some.withColumn("_i", F.explode(F.sequence("_lo", "_hi", F.lit(spec.step if trim else 1).cast("long"))))
    at = F.col("before") + F.col("_i").cast("int")  # 0-based place of the anchor in the arrays
    place = {name: f"_v{j}" for j, (_, name) in enumerate(value_columns(spec))}
    if trim:
        begin, length = at - (past - 1), F.lit(past)
        nulls = F.get("zp", at + 1) - F.get("zp", begin)
        late = F.get("zl", at + shift + future) - F.get("zl", at + shift)
        full = (nulls == 0) & (late == 0)
        if spec.on_null == "drop":
            some = some.filter(full)
        elif spec.on_null == "fail":
            some = some.filter(F.when(~full, F.raise_error(F.lit(W.SHORT_WINDOW))).otherwise(F.lit(True)))
    else:
        begin = F.greatest(at - (past - 1), F.lit(0))
        length = at - begin + 1
    keys = [F.col(f"_s{i}").alias(c) for i, c in enumerate(spec.series)]
    keys += [F.get(place[c], at).alias(c) for c in spec.order if c not in spec.series]
    label = F.slice(place[spec.label], at + (shift + 1), F.lit(future)).alias(spec.label_col)
    windows = [F.slice(place[f], begin + 1, length).alias(f) for f in spec.features]
    keys = [k for k, c in zip(keys, [*spec.series, *[c for c in spec.order if c not in spec.series]]) if c not in spec.features]
    out = some.select(*keys, (first_rn + F.col("_i")).alias(W.RN), label, *windows)
    return out.select(*W.output_columns(out, spec))


def _compacted(df: DataFrame, spec: SequenceSpec) -> DataFrame:
    """Windows without their NULLs, as ``collect_list`` leaves them out."""
    return df.withColumns({c: F.array_compact(c) for c in (*spec.features, spec.label_col)})


def located_blocks(df: DataFrame, spec: SequenceSpec, block_rows: int, rows_per_range: int,
                   rows: int | None = None, metrics: dict | None = None) -> tuple[DataFrame, list[str], bool]:
    """The block table of ``df`` with the place of each piece in its series; the names of its series columns;
    and whether a series may lie in several pieces. ``metrics`` gets the number of series and of short ones."""
    if block_rows < 1 or rows_per_range < 1:
        raise ValueError("rows per block and per range must be >= 1")
    reach = spec.past + spec.shift + spec.future - 2
    ranges = range_count(df.count() if rows is None else rows, max(rows_per_range, 4 * reach))
    keys = [f"_s{i}" for i in range(len(spec.series))]
    while True:
        blocks = block_arrays(df, spec, ranges, max(block_rows, reach))
        pieces, known = located(blocks.groupBy(*keys, PID).agg(F.sum("own").alias(COUNT)), keys)
        # a piece between two others must hold all the rows that the windows beside it reach
        inside = (F.col(ORDINAL) > 1) & (F.col(ORDINAL) < F.col(LAST_ORDINAL)) & (F.col(COUNT) < reach)
        short = not pieces.filter(inside).isEmpty() if known is None else any(1 < r[ORDINAL] < r[LAST_ORDINAL] and r[COUNT] < reach for r in known)
        if ranges == 1 or not short:
            break
        ranges = max(1, ranges // 2)
    if metrics is not None:
        sizes = pieces.filter(F.col(ORDINAL) == 1)
        short = F.col(NB.N_) < spec.past + spec.future + spec.shift - 1
        got = sizes.agg(F.count(F.lit(1)), F.count(F.when(short, 1))).first()
        metrics.update(series=got[0], short_series=got[1])
    blocks = NB.join_on(blocks, pieces.drop(COUNT), [*keys, PID], "inner", broadcast=known is not None)
    return blocks, keys, known is None or any(r[LAST_ORDINAL] > 1 for r in known)


def range_windows(df: DataFrame, spec: SequenceSpec, block_rows: int, rows_per_range: int,
                  trim: bool = True, rows: int | None = None, metrics: list | None = None) -> DataFrame:
    """Sequence windows of every series of ``df`` by ranges and blocks of arrays.

    ``metrics`` gets what is to be added up to the run metrics: a dict, and an observation per branch."""
    counts = {} if metrics is not None else None
    blocks, keys, cut = located_blocks(df, spec, block_rows, rows_per_range, rows, counts)
    if metrics is not None:
        metrics.append(counts)

    def observed(i: int):
        if metrics is None or not trim:
            return None
        metrics.append(Observation(f"ranges_{i}"))
        return metrics[-1]

    if trim and spec.on_null != "keep":
        done = [_slices(blocks, spec, trim, observed(0))]
    else:  # only blocks that hold a NULL pay for taking them out
        has = (F.element_at("zp", -1) > 0) | (F.element_at("zl", -1) > 0)
        done = [_slices(blocks.filter(~has), spec, trim, observed(0)), _compacted(_slices(blocks.filter(has), spec, trim, observed(1)), spec)]
    if cut:
        done.append(border_windows(blocks, spec, keys, trim, observed(2)))
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    return out
