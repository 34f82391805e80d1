"""Result tables."""

from clickloom.sinks.append import append_jdbc, append_parquet
from clickloom.sinks.batch_table import BatchTable

__all__ = ["BatchTable", "append_jdbc", "append_parquet"]
