"""All core queries by name, and the SQL each is held against."""

from __future__ import annotations

from fieldlog.plans import extras, more, problems, reports  # noqa: F401  (extras and more add to the reports)

FLAGSHIP = "season_offense_ranked"
QUERIES = {**problems.QUERIES, **reports.Q}
SQL = {**problems.SQL, **reports.SQL}
