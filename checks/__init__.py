"""Queries over the driver tables, each with the SQL that DuckDB runs as its oracle."""

from checks import composites, primitives, reports
from checks.registry import REGISTRY

__all__ = ["REGISTRY", "composites", "primitives", "reports"]
