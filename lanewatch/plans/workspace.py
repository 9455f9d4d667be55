"""Per-session reuse of shared intermediate tables.

Many reports read the same entity-level tables (features, baseline, scored
routes).  The workspace builds each once per (session, dataset) and keeps it
persisted; ``clear()`` releases everything (the bench calls it between
queries to time each one cold).
"""

from __future__ import annotations

import functools

from lanewatch.session import keep, release_all

_MEMO: dict = {}


def memo(persist: bool = True):
    def deco(fn):
        @functools.wraps(fn)
        def wrapper(spark, sf_dir, *args):
            key = (id(spark._jsparkSession), sf_dir, fn.__name__, args)
            if key not in _MEMO:
                out = fn(spark, sf_dir, *args)
                _MEMO[key] = keep(out) if persist and hasattr(out, "persist") else out
            return _MEMO[key]
        return wrapper
    return deco


def clear() -> None:
    _MEMO.clear()
    release_all()
