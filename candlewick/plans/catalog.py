"""Imports every query module so the registry is complete."""

from candlewick.plans import q_eval, q_features, q_markets, q_models, q_sources  # noqa: F401
from candlewick.plans.registry import REGISTRY  # noqa: F401
