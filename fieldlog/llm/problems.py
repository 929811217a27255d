"""Queries of the problems on texts and names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlog.llm.abuse import score_documents
from fieldlog.llm.canonical import map_values
from fieldlog.llm.mixing import margin_report, mix, share_report
from fieldlog.llm.packing import fill_report, pack, token_counts
from fieldlog.llm.people import link_names, person_pairs
from fieldlog.llm.truncation import club_cut, text_cut
from fieldlog.session import cut
from fieldlog.sources.tables import table

PLAY = ["run_id", "game_id", "play_id"]


def cut_values(spark: SparkSession, folder: str) -> DataFrame:
    plays = table(spark, folder, "plays")
    texts = text_cut(plays, PLAY, "home_team", "raw_text").withColumn("field_name", F.lit("raw_text"))
    clubs = club_cut(plays, PLAY, "home_team", "penalty_team", "game_id", "field_position", ["home_team", "away_team", "offense", "defense"], table(spark, folder, "team_list"))
    return texts.unionByName(clubs.withColumn("field_name", F.lit("penalty_team")))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Plays whose raw_text or penalty_team was cut off."""
    return cut_values(spark, folder).select(*PLAY, "field_name")


def p3_report(spark: SparkSession, folder: str) -> DataFrame:
    """Share of cut values per host and field, over distinct plays that have a value."""
    plays = table(spark, folder, "plays")
    have = plays.select(*PLAY, F.col("home_team").alias("source"), *(F.when(F.trim(c) != "", 1).otherwise(0).alias(c) for c in ("raw_text", "penalty_team"))).groupBy(*PLAY, "source").agg(F.max("raw_text").alias("raw_text"), F.max("penalty_team").alias("penalty_team"))
    have = have.groupBy("source").agg(F.sum("raw_text").alias("raw_text"), F.sum("penalty_team").alias("penalty_team")).unpivot(["source"], ["raw_text", "penalty_team"], "field_name", "n_values")
    cut = cut_values(spark, folder).groupBy("source", "field_name").agg(F.count("*").alias("n_cut"))
    out = have.join(cut, ["source", "field_name"], "left").withColumn("n_cut", F.coalesce("n_cut", F.lit(0)))
    return out.select(F.col("source").alias("home_team"), "field_name", "n_values", "n_cut", F.when(F.col("n_values") > 0, F.col("n_cut") / F.col("n_values")).alias("cut_share"))


def mapped_values(spark: SparkSession, folder: str) -> DataFrame:
    plays, walk = table(spark, folder, "plays"), table(spark, folder, "prefix_crosswalk")
    # One scan of the plays gives both what was typed in a game and its clubs.
    seen = cut(plays.select("game_id", "penalty_team", "home_team", "away_team").distinct())
    typed = seen.select("game_id", F.col("penalty_team").alias("raw_value"), F.lit("plays.penalty_team").alias("field_name"))
    for c in ("prefix_a", "canonical_a"):
        typed = typed.unionByName(walk.select("game_id", F.col(c).alias("raw_value"), F.lit(f"prefix_crosswalk.{c}").alias("field_name")))
    sides = seen.select("game_id", F.explode(F.array("home_team", "away_team")).alias("club"))
    context = sides.unionByName(walk.select("game_id", F.explode(F.array("team_1", "team_2")).alias("club")))
    return map_values(typed, table(spark, folder, "team_list"), context)


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """The club of the list that each typed value means in its game, 0 for none."""
    return mapped_values(spark, folder).select("field_name", "game_id", "raw_value", "team_no")


def p4_report(spark: SparkSession, folder: str) -> DataFrame:
    """Values without an entry of the list, counted per field."""
    mapped = mapped_values(spark, folder)
    return mapped.groupBy("field_name").agg(F.count("*").alias("n_values"), F.count_if(F.col("team_no") == 0).alias("n_unmatched"), F.count_if(F.col("of_game")).alias("n_of_game"))


def linked_names(spark: SparkSession, folder: str) -> DataFrame:
    return link_names(table(spark, folder, "pbp_names"), "name_id", ["season", "team"], "pbp_name", "canonical_name", "position")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every pair of rows that name the same player of a club in a season."""
    return person_pairs(linked_names(spark, folder)).select(F.col("id").alias("name_id_1"), F.col("id2").alias("name_id_2"))


def p5_players(spark: SparkSession, folder: str) -> DataFrame:
    """The player of each row, and under how many spellings that player is found."""
    persons = linked_names(spark, folder)
    n = persons.groupBy("person").agg(F.count("*").alias("n_rows"))
    return persons.join(n, "person").select(F.col("id").alias("name_id"), F.col("person").alias("player"), "n_rows")


def packed_documents(spark: SparkSession, folder: str) -> DataFrame:
    return pack(token_counts(table(spark, folder, "documents"), "doc_id", []), "doc_id")


def p6_containers(spark: SparkSession, folder: str) -> DataFrame:
    """The container of every document or piece."""
    return packed_documents(spark, folder)


def p6_fill(spark: SparkSession, folder: str) -> DataFrame:
    """How well the containers are filled."""
    return fill_report(packed_documents(spark, folder))


def counted_documents(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents"), "doc_id", ["source", "lang", F.col("team_tag").alias("topic")])


def mixed_documents(spark: SparkSession, folder: str) -> DataFrame:
    return mix(counted_documents(spark, folder), table(spark, folder, "mix_targets"))


def p7_mix(spark: SparkSession, folder: str) -> DataFrame:
    """The uses of every document in the mix."""
    return mixed_documents(spark, folder)


def p7_shares(spark: SparkSession, folder: str) -> DataFrame:
    """The share each source reaches beside its target."""
    return share_report(mixed_documents(spark, folder), table(spark, folder, "mix_targets"))


def p7_margins(spark: SparkSession, folder: str) -> DataFrame:
    """Shares of languages and topics in the corpus and in the mix."""
    counted = cut(counted_documents(spark, folder))
    return margin_report(mix(counted, table(spark, folder, "mix_targets")), counted)


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with abusive, hateful or sexual content."""
    return score_documents(table(spark, folder, "documents"), table(spark, folder, "doc_labels")).where("flagged").select("doc_id").distinct()


def p8_scores(spark: SparkSession, folder: str) -> DataFrame:
    """The score of every document."""
    return score_documents(table(spark, folder, "documents"), table(spark, folder, "doc_labels")).select("doc_id", "language", "score", "flagged")


def p8_report(spark: SparkSession, folder: str) -> DataFrame:
    """Rates of flagged documents per source."""
    scored = score_documents(table(spark, folder, "documents"), table(spark, folder, "doc_labels"))
    return scored.groupBy("source").agg(F.count("*").alias("n_documents"), F.count_if("flagged").alias("n_flagged"), F.avg(F.col("flagged").cast("double")).alias("rate"))


QUERIES = {"p3_found": p3_found, "p3_report": p3_report, "p4_found": p4_found, "p4_report": p4_report, "p5_found": p5_found, "p5_players": p5_players, "p6_containers": p6_containers, "p6_fill": p6_fill, "p7_mix": p7_mix, "p7_shares": p7_shares, "p7_margins": p7_margins, "p8_found": p8_found, "p8_scores": p8_scores, "p8_report": p8_report}
SQL: dict[str, str] = {}
