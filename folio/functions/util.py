from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c) -> Column:
    """Accept a Column or a column name."""
    return c if isinstance(c, Column) else F.col(c)


def lit_or_col(c) -> Column:
    """Accept a Column or a Python literal."""
    return c if isinstance(c, Column) else F.lit(c)


def let(value: Column, body) -> Column:
    """Bind ``value`` once and evaluate ``body(bound)``; keeps large sub-expressions
    from being copied into every place that refers to them."""
    return F.element_at(F.transform(F.array(value), body), 1)


_COLUMN_CACHE: dict = {}


def cached_columns(fn):
    """Memoise a builder of Column expressions per SparkContext.

    Expression trees over fixed column names do not depend on the data; building
    them costs one JVM round trip per node, so large trees are built once.
    """
    def wrapper(*args):
        from pyspark import SparkContext
        sc = SparkContext._active_spark_context
        key = (fn.__module__, fn.__qualname__, args)
        if key not in _COLUMN_CACHE or _COLUMN_CACHE[key][0] is not sc:
            _COLUMN_CACHE[key] = (sc, fn(*args))
        return _COLUMN_CACHE[key][1]
    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    return wrapper
