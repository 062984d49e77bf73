"""All queries of the library with their SQL."""

from tapewright.plans import dataset_queries, dataset_rows, finance_queries, storage_queries  # register their queries
from tapewright.plans.queries import QUERIES, SQL, returned

__all__ = ["QUERIES", "SQL", "dataset_queries", "dataset_rows", "finance_queries", "returned", "storage_queries"]
