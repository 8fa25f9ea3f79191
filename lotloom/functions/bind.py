"""Names for intermediate values inside one expression."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once. An expression is a tree, so a value that a
    body mentions several times would otherwise be copied, and copies of copies multiply.

    It is the start of an aggregation over nothing, whose end is the body: unlike the only element of a transformed array,
    this neither copies the result nor asks for the type of the whole body at each row.
    """
    return F.aggregate(F.array().cast("array<int>"), value, lambda v, _: v, lambda v: body(v))


def built_once(build: Callable[..., Column]) -> Callable[..., Column]:
    """Builds a column once a Spark application for the same arguments, which must be hashable.

    A large expression over named columns takes thousands of calls to the JVM; as it is bound to no table it serves any
    number of plans.
    """
    built: dict = {}

    @wraps(build)
    def get(*args) -> Column:
        context = SparkContext._active_spark_context
        key = (context.applicationId if context else None, *args)
        if key not in built:
            built[key] = build(*args)
        return built[key]

    return get
