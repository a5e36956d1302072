"""Composed plans: the shared fan-out transform, bulk load, and the query catalog."""

from fanwrite.plans.bulk import bulk_load
from fanwrite.plans.fanout import Preparer, enrich_constants, prepare

__all__ = ["Preparer", "bulk_load", "enrich_constants", "prepare"]
