"""The query catalogue; importing this registers every query."""

from . import articles, collection, content, editorial, matching, publishing, records, streams
from .registry import FIXTURE_SQL, FIXTURES, ORACLE_SQL, QUERIES

__all__ = ["FIXTURES", "FIXTURE_SQL", "ORACLE_SQL", "QUERIES", "articles", "collection", "content", "editorial", "matching", "publishing", "records", "streams"]
