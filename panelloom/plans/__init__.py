"""Named queries; importing the modules registers them."""

from panelloom.plans import q_align, q_clean, q_features, q_models, q_sources  # noqa: F401
from panelloom.plans.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
