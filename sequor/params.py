"""Parameter objects shared by every operator.

Two groups:

* :class:`SequenceSpec` says how a long table becomes supervised sequences:
  which columns identify a series, how rows are ordered inside it, which
  columns become past windows and which column is the label base.
* :class:`TrainingParams` carries the dataset-feeding and sizing knobs
  (batch size, epochs, seed, split fractions, ...).

Both are plain frozen dataclasses so they can be hashed, logged and passed to
executors (they are captured by value in pandas UDF closures).
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# Fixed values that must equal the reference's for the same results.
# Default feature names of a raw series, in order, and the label naming rule.
DEFAULT_FEATURES = (
    "ohlc_close",
    "ohlc_pcr",
    "ohlc_usw",
    "ohlc_lsw",
    "bas_rq",
    "vol_rq",
    "cmmc_max",
)
DEFAULT_LABEL_BASE = "ohlc_close"
LABEL_SUFFIX = "_label"
DEFAULT_INDEX_COL = "s_ts"
# Sizing and feeding defaults of the reference's configuration.
DEFAULT_PAST = 60
DEFAULT_FUTURE = 3
DEFAULT_BATCH = 64
DEFAULT_EPOCHS = 10
DEFAULT_SHIFT = 1
DEFAULT_STEP = 1
DEFAULT_TEST_SIZE = 0.2
DEFAULT_VAL_SIZE = 0.2
SHUFFLE_RATIO = 0.10
DEFAULT_SEED = 13
DEBUG_STEPS = 50
# Channel names and the directories they live in.
CHANNEL_DIRS = {"train": "train", "eval": "evaluation", "test": "validation"}
DEFAULT_DATA_TYPE = "price"
DEFAULT_EXCHANGE = "bn"
SAVED_MODEL_FILE = "saved_model.pb"
# Date directories: two-digit month, day and year; the year is read with
# the century "20" in front of it.
DATE_DIR_FORMAT = "MM-dd-yy"
DATE_CENTURY_PREFIX = "20"

NULL_MODES = ("drop", "keep", "fail")


@dataclass(frozen=True)
class SequenceSpec:
    """How a table of many series turns into (past window, future label) rows.

    series:   columns identifying one series (the partition key).
    order:    columns ordering rows inside a series; the first one is the time
              index, the rest break ties. Rows are ordered ascending with NULLs
              first, as Spark and the reference do.
    features: columns turned into trailing windows of ``past`` rows
              (the current row and the ``past - 1`` rows before it).
    label:    the label base column; its next ``future`` rows (starting
              ``shift`` rows after the anchor) become the target.
    step:     keep every ``step``-th anchor, counted from the first full one.
    on_null:  "drop" (default) keeps only anchors whose every window is full;
              "keep" reproduces the reference (NULLs vanish from windows, short
              windows survive); "fail" raises at run time on a short window.
    keep_keys: keep series keys, the anchor time and ``rn`` in the output.
    nested:   build windows directly in the float32 record layout
              ``array<array<float>>`` (``[[x], ...]``) inside the window
              aggregate, instead of converting afterwards.
    """

    series: tuple[str, ...] = ("symbol",)
    order: tuple[str, ...] = (DEFAULT_INDEX_COL,)
    features: tuple[str, ...] = DEFAULT_FEATURES
    label: str = DEFAULT_LABEL_BASE
    past: int = DEFAULT_PAST
    future: int = DEFAULT_FUTURE
    step: int = DEFAULT_STEP
    shift: int = DEFAULT_SHIFT
    on_null: str = "drop"
    keep_keys: bool = True
    nested: bool = False

    def __post_init__(self):
        for name in ("series", "order", "features"):
            value = getattr(self, name)
            if isinstance(value, str):
                object.__setattr__(self, name, (value,))
            else:
                object.__setattr__(self, name, tuple(value))
        if not self.series:
            raise ValueError("at least one series column is required")
        if not self.order:
            raise ValueError("at least one order column is required")
        if self.past < 1 or self.future < 1:
            raise ValueError("past and future must be >= 1")
        if self.step < 1 or self.shift < 1:
            raise ValueError("step and shift must be >= 1")
        if self.on_null not in NULL_MODES:
            raise ValueError(f"on_null must be one of {NULL_MODES}")

    @property
    def label_col(self) -> str:
        return self.label + LABEL_SUFFIX

    @property
    def time_col(self) -> str:
        return self.order[0]

    def with_(self, **kw) -> SequenceSpec:
        return replace(self, **kw)


@dataclass(frozen=True)
class TrainingParams:
    """Feeding and sizing parameters (batch, epochs, seed, split fractions)."""

    batch_size: int = DEFAULT_BATCH
    epochs: int = DEFAULT_EPOCHS
    seed: int = DEFAULT_SEED
    shuffle_ratio: float = SHUFFLE_RATIO
    test_size: float = DEFAULT_TEST_SIZE
    val_size: float = DEFAULT_VAL_SIZE
    max_steps: int | None = None
    extra: dict = field(default_factory=dict, compare=False, hash=False)

    def __post_init__(self):
        if self.batch_size < 1 or self.epochs < 1:
            raise ValueError("batch_size and epochs must be >= 1")
        if not (0 <= self.test_size < 1 and 0 <= self.val_size < 1):
            raise ValueError("split fractions must be in [0, 1)")
        if self.test_size + self.val_size >= 1:
            raise ValueError("test_size + val_size must be < 1")
