"""Bindings of every operator to the given tables, grouped by family."""

from corpusgauge.bindings import (  # noqa: F401
    audits, generation, incremental, preparation, shredding, spatial, statistics,
)
from corpusgauge.bindings.registry import QUERIES, SQL  # noqa: F401
