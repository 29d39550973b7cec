"""sequor: time series to supervised sequences and per-series forecasts, as Spark jobs.

Entry points:

* :func:`sequor.operators.windows.sequence_windows` - past/future windows for every series;
* :mod:`sequor.operators.split`, :mod:`sequor.operators.dataset` - split and feeding;
* :mod:`sequor.operators.forecast`, :mod:`sequor.operators.registry` - models;
* :mod:`sequor.sources` - CSV series trees, Parquet and TFRecord sinks/sources;
* :mod:`sequor.plans.jobs` - end-to-end jobs; :mod:`sequor.streaming` - file-triggered transform.
"""

from .params import SequenceSpec, TrainingParams

__all__ = ["SequenceSpec", "TrainingParams"]
__version__ = "0.1.0"
