from rowferry.queries import civil_loads, clean, indexes, joins, loads, merges, reports, scans, shapes, streams  # noqa: F401
from rowferry.queries.registry import ORACLE_SQL, QUERIES


def available_queries() -> list[str]:
    return sorted(QUERIES)


__all__ = ["ORACLE_SQL", "QUERIES", "available_queries"]
