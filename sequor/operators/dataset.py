"""Dataset feeding as table operators (D1-D5) and sizing (A2-A4).

A training loop consumes records shuffled per epoch, repeated for several
epochs and cut into fixed-size batches (the last incomplete batch of an epoch
is dropped), for a bounded number of steps. Here each of those is a column:

* ``epoch``      - D2, ``explode(sequence(1, epochs))``;
* ``shuffle_key``- D1, ``md5(seed | epoch | record key)``: a full, fixed-seed
                   reshuffle per epoch that is the same on every engine and
                   under any partitioning (unlike ``rand(seed)``);
* ``pos``        - 1-based position inside the epoch, by ``shuffle_key`` (or by
                   the record key in an unshuffled pass);
* ``batch_id``   - D3, ``(pos - 1) div batch_size``, complete batches only;
* ``step``       - global step ``(epoch - 1) * batches_per_epoch + batch_id``;
                   D4 keeps ``step < max_steps``.

Global positions never go through one task: the first hex digits of the md5
key form uniform buckets, bucket counts give offsets, and ``row_number`` runs
per (epoch, bucket) (see :mod:`sequor.plans.numbering`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..params import DEBUG_STEPS, TrainingParams
from ..plans.numbering import BUCKET, MAX_BROADCAST_HOT, number_bucketed
from ..plans.ranges import number_ranges

PROBE_DIGITS = 3
#: Rows that a task copies for all epochs together.
COPIED_ROWS = 4_000_000

SHUFFLE_KEY = "shuffle_key"


def shuffle_key(epoch: Column, key_cols: Sequence[str], seed: int) -> Column:
    """``md5('<seed>|<epoch>|<k1>|<k2>...')`` as lowercase hex."""
    parts = [F.lit(str(seed)), epoch.cast("string")] + [F.col(c).cast("string") for c in key_cols]
    return F.md5(F.concat_ws("|", *parts))


def repeat_epochs(df: DataFrame, epochs: int, epoch_col: str = "epoch") -> DataFrame:
    """One copy of every row per epoch (1-based)."""
    if epochs < 1:
        raise ValueError("epochs must be >= 1")
    return df.withColumn(epoch_col, F.explode(F.sequence(F.lit(1), F.lit(epochs))))


def epoch_shuffle(df: DataFrame, key_cols: Sequence[str], params: TrainingParams = TrainingParams(),
                  epochs: int | None = None) -> DataFrame:
    """D1 + D2: repeat for ``epochs`` and attach the per-epoch shuffle key."""
    e = params.epochs if epochs is None else epochs
    out = repeat_epochs(df, e)
    return out.withColumn(SHUFFLE_KEY, shuffle_key(F.col("epoch"), key_cols, params.seed))


def batches(
    df: DataFrame,
    key_cols: Sequence[str],
    params: TrainingParams = TrainingParams(),
    epochs: int | None = None,
    prefix_digits: int | None = None,
    max_steps: int | None = None,
    debug: bool = False,
    rows_per_bucket: int = 1_000_000,
    shuffle: bool = True,
) -> DataFrame:
    """``epoch, shuffle_key, pos, batch_id, step`` for every kept row.

    Every column of ``df`` moves with its row, once per epoch, so feed narrow rows (the record key, or what a batch
    needs of it) and join windows to the result. A step cap is applied before any row is copied: epochs that lie
    beyond it are not made at all. ``shuffle=False`` is the plain pass: records in the order of ``key_cols``,
    numbered once for all epochs, without a shuffle key.

    ``prefix_digits`` hex digits of the shuffle key make ``16 ** prefix_digits``
    uniform buckets per epoch for the two-phase numbering. By default one small
    job counts rows per (epoch, bucket) of up to 3 digits, as many as the collect
    bound allows: with buckets of at most ``rows_per_bucket`` rows those counts give the
    offsets directly and the rows move once; otherwise the digits are sized so a bucket holds about
    ``rows_per_bucket`` rows, which also keeps the per-epoch offsets table at
    about ``records / rows_per_bucket`` rows. ``max_steps`` (or
    ``debug=True`` for the debug cap) bounds the global step.
    """
    B = params.batch_size
    cap = DEBUG_STEPS if debug else (max_steps if max_steps is not None else params.max_steps)
    epochs = params.epochs if epochs is None else epochs
    if cap is not None:
        epochs = min(epochs, epochs_within(df.count(), B, cap))
    if not shuffle:
        numbered = number_ranges(df, [], list(key_cols), rows_per_bucket, rn="pos", n="_sq_epoch_n")
        return _batched(repeat_epochs(numbered, epochs), B, cap)
    repeated = repeat_epochs(df, epochs)
    key = shuffle_key(F.col("epoch"), key_cols, params.seed)
    order = [SHUFFLE_KEY, *key_cols]

    def bucket(digits: int) -> Column:
        return F.conv(F.substring(key, 1, digits), 16, 10).cast("long").alias(BUCKET)

    def dealt(rows: DataFrame, digits: int) -> DataFrame:
        """Rows by (epoch, bucket): the key itself doesn't move, it is taken again where the rows arrive."""
        return rows.select("*", bucket(digits)).repartition("epoch", BUCKET).withColumn(SHUFFLE_KEY, key)

    numbered = None
    if prefix_digits is None:
        # One small job: counts per (epoch, bucket) of as many digits as the collect bound allows. When its
        # buckets are not too big, they give the offsets directly (broadcast, one data shuffle);
        # otherwise the counts size the buckets for the general path.
        digits = probe_digits(epochs)
        if digits:
            counts_q = repeated.select("epoch", bucket(digits)).groupBy("epoch", BUCKET).agg(F.count(F.lit(1)).alias("_sq_c"))
            rows = counts_q.collect()  # at most epochs * 16 ** digits
            per_epoch_n = sum(r["_sq_c"] for r in rows if r["epoch"] == 1)  # each epoch holds all records
            if per_epoch_n <= rows_per_bucket * 16 ** digits:
                counts = df.sparkSession.createDataFrame(rows, counts_q.schema)
                tasks = -(-per_epoch_n * epochs // COPIED_ROWS)
                if tasks > df.sparkSession.sparkContext.defaultParallelism:  # copies of few large partitions would spill as they are dealt
                    repeated = repeat_epochs(df.repartition(tasks, *key_cols), epochs)
                numbered = number_bucketed(dealt(repeated, digits), ["epoch"], order, rn="pos", total="_sq_epoch_n", counts=counts)
            prefix_digits = bucket_digits(per_epoch_n, rows_per_bucket)
        else:
            # sized by the records of an epoch (each epoch holds them all), never by the probe's table
            prefix_digits = bucket_digits(df.count(), rows_per_bucket)
    if numbered is None:
        if not 1 <= prefix_digits <= 8:
            raise ValueError("prefix_digits must be in 1..8")
        tagged = repeated.select("*", key.alias(SHUFFLE_KEY), bucket(prefix_digits))
        numbered = number_bucketed(tagged, ["epoch"], order, rn="pos", total="_sq_epoch_n")
    return _batched(numbered, B, cap).drop(BUCKET)


def probe_digits(epochs: int) -> int:
    """Hex digits of the probe: its table has at most ``epochs * 16 ** digits`` rows, within the collect bound."""
    return max(d for d in range(PROBE_DIGITS + 1) if d == 0 or epochs * 16 ** d <= MAX_BROADCAST_HOT)


def epochs_within(records: int, batch_size: int, cap: int) -> int:
    """Epochs that hold a step below the cap; 1 at least, so that the result keeps its columns."""
    per_epoch = records // batch_size
    return max(1, -(-cap // per_epoch)) if per_epoch else 1


def _batched(numbered: DataFrame, batch_size: int, cap: int | None) -> DataFrame:
    """Batches and steps of numbered records (``epoch``, ``pos``, ``_sq_epoch_n``); incomplete batches go."""
    per_epoch = F.floor(F.col("_sq_epoch_n") / F.lit(batch_size)).cast("long")
    batch_id = F.floor((F.col("pos") - F.lit(1)) / F.lit(batch_size)).cast("long")
    out = numbered.withColumn("batch_id", batch_id).withColumn(
        "step", (F.col("epoch") - F.lit(1)).cast("long") * per_epoch + F.col("batch_id")
    )
    out = out.filter(F.col("batch_id") < per_epoch)
    if cap is not None:
        out = out.filter(F.col("step") < F.lit(cap))
    return out.drop("_sq_epoch_n")


def bucket_digits(records: int, rows_per_bucket: int = 1_000_000) -> int:
    """Hex digits so that ``records / 16 ** digits`` is about ``rows_per_bucket`` (1..8)."""
    digits = 1
    while digits < 8 and records / (16 ** digits) > rows_per_bucket:
        digits += 1
    return digits


# --- sizing (A2-A4) ---------------------------------------------------------


def dataset_lengths(df: DataFrame, group_cols: Sequence[str] = ("channel", "date", "symbol"),
                    name: str = "ds_len") -> DataFrame:
    """A2: rows per (channel, date, symbol) for all series at once."""
    return df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias(name))


def max_steps_expr(n: Column, epochs: int, batch_size: int) -> Column:
    """A3, reference formula: ``int(epochs * ((n / epochs) / batch))``.

    The epochs cancel, so this is ``floor(n / batch)``: the reference trains
    one epoch's worth of steps. Evaluated in double exactly as written.
    """
    per_epoch = (n.cast("double") / F.lit(float(epochs))) / F.lit(float(batch_size))
    return F.floor(F.lit(float(epochs)) * per_epoch).cast("long")


def shuffle_buffer_expr(n: Column, ratio: float) -> Column:
    """A4: ``int(n * ratio)`` (truncation of a non-negative double)."""
    return F.floor(n.cast("double") * F.lit(ratio)).cast("long")


def sizing(lengths: DataFrame, params: TrainingParams = TrainingParams(), n_col: str = "ds_len") -> DataFrame:
    """A2-A4 together: reference steps, true epoch steps and shuffle buffer."""
    n = F.col(n_col)
    return lengths.withColumns({
        "max_steps": max_steps_expr(n, params.epochs, params.batch_size),
        "epoch_steps": (F.lit(params.epochs) * F.floor(n / F.lit(params.batch_size))).cast("long"),
        "shuffle_buffer": shuffle_buffer_expr(n, params.shuffle_ratio),
    })
