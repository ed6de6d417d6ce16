"""Reuse of expression trees within a Spark application.

Building a parser's columns takes about a thousand Python-to-JVM calls;
the trees only refer to column names, so they are built once per Spark
application and reused by every DataFrame that needs them (column
expressions are immutable).  The key includes the application id, so a
restarted session never sees expressions of a stopped one.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from typing import TypeVar

from pyspark import SparkContext

T = TypeVar("T")


def session_cached(fn: Callable[..., T]) -> Callable[..., T]:
    cache: dict[tuple, T] = {}

    @functools.wraps(fn)
    def wrapper(*args):
        sc = SparkContext._active_spark_context
        key = (sc.applicationId if sc is not None else None, args)
        if key not in cache:
            cache[key] = fn(*args)
        return cache[key]

    return wrapper
