"""Pandas functions as column functions; the Spark function is made on use, so modules import without a session."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def vectorised(returns: str) -> Callable[[Callable], Callable[..., Column]]:
    def wrap(f: Callable) -> Callable[..., Column]:
        def call(*cols: Column | str) -> Column:
            return F.pandas_udf(f, returns)(*cols)

        call.__doc__, call.__name__ = f.__doc__, f.__name__
        return call

    return wrap
