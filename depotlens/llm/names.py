"""Columns that an operator passes through, kept apart from the names it uses itself."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import wraps

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keeps_columns(reads: Sequence[str], results: Sequence[str]) -> Callable:
    """For operators that return the given columns and ``results``: whatever the other columns are called, they stay.

    Inside, the columns that the operator does not read have names that it cannot use; outside, they have their own again.
    Given columns named like a result are replaced. An operator may return more than the frame; that is passed on.
    """

    def decorate(operator: Callable) -> Callable:
        @wraps(operator)
        def run(docs: DataFrame, *args, **kwargs):
            given = [c for c in docs.columns if c not in results]
            inside = {c: c if c in reads else f"_given_{i}" for i, c in enumerate(given)}
            out = operator(docs.select(*(F.col(f"`{c}`").alias(n) for c, n in inside.items())), *args, **kwargs)
            frame, more = (out[0], out[1:]) if isinstance(out, tuple) else (out, None)
            frame = frame.select(*(F.col(n).alias(c) for c, n in inside.items()), *results)
            return frame if more is None else (frame, *more)

        return run

    return decorate
