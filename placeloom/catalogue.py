"""All queries of the core and their SQL."""

from placeloom.queries import ORACLE, QUERIES, browse, cascades, matching, near, ranking, reading, records, text

__all__ = ["ORACLE", "QUERIES", "browse", "cascades", "matching", "near", "ranking", "reading", "records", "text"]
