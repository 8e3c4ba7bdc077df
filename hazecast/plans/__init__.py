"""All registered queries."""

from hazecast.plans import analysis, features, modelling, storage
from hazecast.plans.registry import QUERIES

__all__ = ["QUERIES", "analysis", "features", "modelling", "storage"]
