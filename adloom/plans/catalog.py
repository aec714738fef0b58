"""Everything that is registered: importing the plan modules fills the registry."""

from adloom.plans import details, documents, geo, listings, pages, records, scalars, state, streams, urls  # noqa: F401
from adloom.plans.documents import flagship
from adloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "flagship"]
