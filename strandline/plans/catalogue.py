"""All registered queries: importing a family's module registers its queries."""

from __future__ import annotations

from . import frequency, ordering, ranges, repeats, methylation, graphs, identity, qtl, operations, samples, scalars, files  # noqa: F401
from .bindings import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
