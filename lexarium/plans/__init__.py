"""Named queries over the test tables, each with the SQL that gives the same rows."""

from . import domain, records, relational, stream
from .base import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "domain", "records", "relational", "stream"]
