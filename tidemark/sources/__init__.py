from tidemark.sources.reader import read_query, read_table

__all__ = ["read_query", "read_table"]
