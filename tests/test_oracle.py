"""A cross-section of the registered queries beside their SQL, on the smallest data."""

import duckdb
import pytest

import __spark_entry__ as entry
from compare import TABLES, cell

NAMES = ["p1_found", "p1_report", "p2_found", "p2_report", "current_runs", "standings_current", "schedule_current", "play_context", "season_offense_ranked", "situation_defense_ranked", "drives_offense_ranked", "season_points_ranked", "team_leaders", "dashboard_filtered", "table_third_down_defense", "table_redzone_offense", "chart_games", "season_check", "crosswalk_seed", "parse_play_text", "games_from_schedule", "team_folds", "events_stream", "situation_trimmed", "identity_lines", "game_offense_all_runs", "health_balance", "roster_distinct", "names_chosen", "names_applied"]


@pytest.fixture(scope="module")
def con(folder):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, folder, con, name):
    df = entry.queries()[name](spark, folder)
    columns = sorted(df.columns)
    got = sorted((tuple(cell(r[c]) for c in columns) for r in df.collect()), key=repr)
    res = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == columns
    assert got == sorted((tuple(cell(r[cols.index(c)]) for c in columns) for r in res.fetchall()), key=repr)


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark, folder):
    assert entry.entry(spark).limit(1).count() == 1
