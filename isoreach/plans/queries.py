"""All registered queries of the reference's operators."""

from isoreach.plans import access_queries, catalog_queries, extra_queries, more_queries, network_queries, table_queries  # noqa: F401
from isoreach.plans.domain import REGISTRY

__all__ = ["REGISTRY"]
