"""The registered queries, each next to the SQL that states its result independently."""

from maskwright.queries import (  # noqa: F401
    detection,
    evaluation,
    folders,
    listings,
    registries,
    streams,
    structured,
)
from maskwright.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
