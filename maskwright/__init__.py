"""Personal-data detection and de-identification as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

from maskwright.operators.policy import GeneratorMetadata, LabelList, RedactOptions
from maskwright.operators.redact import detect, redact, redact_array, spans_of, transform_spans

__all__ = [
    "GeneratorMetadata",
    "LabelList",
    "RedactOptions",
    "detect",
    "redact",
    "redact_array",
    "spans_of",
    "transform_spans",
]

# Functions sent to Python workers travel with their code: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
