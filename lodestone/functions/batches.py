"""Python functions as Spark columns, once for each distinct value of an Arrow batch."""

from collections.abc import Callable

import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

_MADE: dict = {}


def per_value(name: str, fn: Callable, ddl: str, kind: pa.DataType) -> Callable[[Column], Column]:
    """A column function that applies ``fn`` to each distinct value that is not null.

    Null gives null. The same ``name`` gives the same function within one context, so that an
    expression used several times in a projection is evaluated once.
    """
    context = SparkContext._active_spark_context
    if _MADE.get("context") is not context:
        _MADE.clear()
        _MADE["context"] = context
    if name not in _MADE:

        def run(a: pa.Array) -> pa.Array:
            plain = pa.types.is_string(a.type) or pa.types.is_large_string(a.type)
            if not plain:
                return pa.array([None if v is None else fn(v) for v in a.to_pylist()], type=kind)
            d = a.dictionary_encode()
            return pa.array([fn(v) for v in d.dictionary.to_pylist()], type=kind).take(d.indices)

        _MADE[name] = F.arrow_udf(run, ddl)
    return _MADE[name]
