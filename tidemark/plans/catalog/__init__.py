"""All registered queries and their SQL twins."""

from tidemark.plans.catalog import (  # noqa: F401  (imports register the queries)
    cleaning,
    flows,
    grouping,
    joining,
    learning,
    mining,
    models,
    monitoring,
    scalars,
    sources,
    statistics,
)
from tidemark.plans.catalog.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
