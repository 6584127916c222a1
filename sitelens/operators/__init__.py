"""Relational building blocks: joins, set operations, grouped selections, reshaping."""
