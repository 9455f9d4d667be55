"""Queries of the training-data operators and their DuckDB SQL."""

from lanewatch.llm import (  # noqa: F401  (each fills the registry)
    decontam,
    fingerprint,
    hardneg,
    langid,
    neardup,
    packing,
    prefixbpe,
    repair,
    sharding,
    tokencount,
    urlfilter,
    warc,
    substring,
)
from lanewatch.llm.common import ORACLE, QUERIES  # noqa: F401
