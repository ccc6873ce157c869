"""All registered queries of the library."""

from __future__ import annotations

from . import queries as _queries  # noqa: F401  (each module registers its queries)
from . import reports as _reports  # noqa: F401
from . import sampling as _sampling  # noqa: F401
from . import snapshots as _snapshots  # noqa: F401
from .registry import QUERIES, SQL, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
