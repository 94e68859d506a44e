"""Memoisation of Column expressions.

A Column is an immutable, unresolved expression tree, so the same object can
be used in any number of DataFrames.  Building one from Python costs a JVM
round trip per node; the builders below are therefore cached for the JVM
gateway they were built on.  The cache holds that gateway itself (not its id,
which could be given to another object) and is emptied when it is replaced.
"""

from __future__ import annotations

import functools

from pyspark import SparkContext


def cached_expr(fn):
    cache: dict = {}
    owner: list = [None]

    @functools.wraps(fn)
    def wrapper(*args):
        if owner[0] is not SparkContext._gateway:
            cache.clear()
            owner[0] = SparkContext._gateway
        try:
            return cache[args]
        except KeyError:
            pass
        except TypeError:  # unhashable argument (a Column): build directly
            return fn(*args)
        out = cache[args] = fn(*args)
        return out

    wrapper.cache = cache
    return wrapper
