"""Silver tables from the raw ones: games from schedules, players from JSON, incremental and replacing writes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Position groups (fixed values).
GROUPS = {"QB": "qb", "RB": "rb", "FB": "rb", "HB": "rb", "SB": "rb", "TB": "rb", "WR": "wr", "TE": "wr", "DL": "d", "LB": "d", "DB": "d", "D": "d", "K": "k", "P": "p", "KR": "kr"}


def games_from_schedule(schedule: DataFrame) -> DataFrame:
    """One row per run and game: its teams, the sides where they are unique, and how well the rows pair up."""
    rows = schedule.where("game_id IS NOT NULL AND trim(game_id) <> ''").distinct()
    side = lambda s: F.sort_array(F.collect_set(F.when(F.col("home_away") == s, F.col("team_name"))))
    g = rows.groupBy("run_id", "season", "game_id").agg(F.min("game_date").alias("game_date"), F.count("*").alias("rows"), F.sort_array(F.collect_set("team_name")).alias("teams"), side("home").alias("h"), side("away").alias("a"), F.max("schedule_home").alias("schedule_home"), F.max("schedule_away").alias("schedule_away"))
    n = F.size("teams")
    status = F.when((n == 2) & (F.col("rows") == 2), "paired").when(n == 2, "duplicate-rows").when(n == 1, "single-sided").when(n > 2, "over-paired").otherwise("incomplete")
    one = lambda c: F.when(F.size(c) == 1, F.try_element_at(c, F.lit(1)))
    return g.select("run_id", "season", "game_id", "game_date", "schedule_home", "schedule_away", one("h").alias("home_team_canonical"), one("a").alias("away_team_canonical"), F.try_element_at("teams", F.lit(1)).alias("team_1"), F.try_element_at("teams", F.lit(2)).alias("team_2"), F.col("rows").alias("schedule_row_count"), n.cast("bigint").alias("unique_team_count"), status.alias("pairing_status"))


PLAYERS = "struct<individuals: array<struct<playerId: string, pageName: string, fullName: string, firstName: string, lastName: string, team: string, teamId: string, position: string, uniform: string, year: string, active: boolean, stats: map<string, string>>>>"


def stat(key: str) -> F.Column:
    """A statistic of the sparse map as a number; '%' is dropped, what is no number is NULL."""
    return F.rtrim(F.trim(F.try_element_at("stats", F.lit(key))), F.lit("%")).try_cast("double")


def players_from_json(raw: DataFrame, json_text: str, stats: list[str]) -> DataFrame:
    """Player rows of conference JSON: identity, position group ('other' by default) and the wanted statistics."""
    rows = raw.select("run_id", "season", F.explode(F.from_json(json_text, PLAYERS)["individuals"]).alias("p")).select("run_id", "season", "p.*")
    first = F.upper(F.trim(F.split_part(F.coalesce("position", F.lit("")), F.lit("/"), F.lit(1))))
    group = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in GROUPS.items() for x in kv)), first), F.lit("other"))
    return rows.select("run_id", "season", "playerId", "fullName", "team", "position", group.alias("position_group"), *(stat(k).alias(k) for k in stats))


def json_urls(text: str) -> F.Column:
    """JSON addresses in a page, each once in order of appearance."""
    return F.array_distinct(F.regexp_extract_all(F.col(text), F.lit(r"https?://[^\s\"'<>]+\.json"), F.lit(0)))


def source_kind(url: str) -> F.Column:
    """What a JSON address holds, by its name (kinds are fixed values)."""
    u = F.lower(F.col(url))
    return F.when(u.contains("legend") | u.contains("metadata"), "metadata_legend_json").when(u.contains("players"), "players_json").when(u.contains("teams"), "teams_json").when(u.contains("team"), "team_json").otherwise("other")


def not_done(rows: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key hasn't been processed yet."""
    return rows.join(done.select(*key).distinct(), key, "left_anti")


def replaced(stored: DataFrame, delivered: DataFrame, key: list[str]) -> DataFrame:
    """Stored rows with those of delivered keys replaced by what was delivered."""
    return not_done(stored, delivered, key).unionByName(delivered, allowMissingColumns=True)


def names_of_plays(plays: DataFrame) -> DataFrame:
    """Every player name of the plays with its team and roles ('/'-joined)."""
    role = "stack(5, passer, offense, 'passer', rusher, offense, 'rusher', receiver, offense, 'receiver', tackler_1, defense, 'defender', tackler_2, defense, 'defender') AS (pbp_name, team, role)"
    rows = plays.select("season", F.expr(role)).where("pbp_name IS NOT NULL AND trim(pbp_name) <> '' AND team IS NOT NULL AND team <> ''")
    return rows.groupBy("season", "team", "pbp_name").agg(F.array_join(F.sort_array(F.collect_set("role")), "/").alias("role"))


def flag_unlisted(names: DataFrame, rosters: DataFrame) -> DataFrame:
    """Names with 'no_roster' where their team has no roster rows."""
    have = rosters.select("season", "team").distinct().withColumn("__listed", F.lit(True))
    return names.join(have, ["season", "team"], "left").withColumn("flagged", F.when(F.col("__listed"), "").otherwise("no_roster")).drop("__listed")


def resolve_penalty_team(values: DataFrame, teams: DataFrame) -> DataFrame:
    """A typed team to the one of its game that it names in full, or that alone begins with it, or alone has its first word.

    ``values``: game_id, token; ``teams``: game_id, team.
    """
    u = lambda c: F.upper(F.trim(c))
    rows = values.select("game_id", "token").where("trim(token) <> ''").distinct().join(teams.select("game_id", "team").where("team <> ''").distinct(), "game_id", "left")
    exact, begins, word = u("team") == u("token"), F.startswith(u("team"), u("token")), F.split_part(u("team"), F.lit(" "), F.lit(1)) == F.split_part(u("token"), F.lit(" "), F.lit(1))
    only = lambda c: F.when(F.count_if(c) == 1, F.max(F.when(c, F.col("team"))))
    return rows.groupBy("game_id", "token").agg(F.coalesce(F.max(F.when(exact, F.col("team"))), only(begins), only(word)).alias("team"))


def first_games(rows: DataFrame, n: int) -> DataFrame:
    """Rows of the first n games in order; these n are the only ones that are brought together."""
    if n <= 0:
        raise ValueError(f"number of games: {n}")
    keep = rows.select("game_id").where("game_id IS NOT NULL").distinct().orderBy("game_id").limit(n)
    return rows.join(F.broadcast(keep), "game_id", "left_semi")
