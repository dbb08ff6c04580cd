from snowloom.queries import auditing, conforming, joining, keeping, keying, loading, storing, wide  # noqa: F401
from snowloom.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
