"""Registered queries: each operator bound to the given tables, with an independent SQL oracle."""

from periodica.catalog import (  # noqa: F401
    checks,
    files,
    functions,
    history,
    incremental,
    relational,
    reporting,
    streams,
)
from periodica.catalog.registry import ORACLES, QUERIES  # noqa: F401
