"""All registered queries."""

from starmart.plans import ingest_queries, mart_queries, stream_queries, table_queries  # noqa: F401
from starmart.plans.registry import QUERIES, SQL  # noqa: F401
