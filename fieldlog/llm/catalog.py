"""Queries of this subpackage by name, and the SQL some are held against."""

from __future__ import annotations

from fieldlog.llm import problems

QUERIES = {**problems.QUERIES}
SQL = {**problems.SQL}
