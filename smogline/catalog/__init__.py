"""Query catalog: Spark callables and their SQL oracles, keyed by operator."""

from . import registry_io, registry_ml  # noqa: F401  (register file-backed, MLlib and stream queries)
from .registry import ORACLES, QUERIES, normalize


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)


__all__ = ["queries", "oracle_sql", "normalize"]
