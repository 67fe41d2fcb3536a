"""Imports all query modules, which fills the registry."""

from boxloom.plans import box_queries, crawl_queries, image_queries, review_queries, stream_queries, train_queries  # noqa: F401
from boxloom.plans.catalog import ORACLES, QUERIES  # noqa: F401
