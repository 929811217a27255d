"""Spellings of one person: reading, alignment and linking."""

import pytest

from fieldlog.llm.people import components, link_names, person_pairs, read_name

ROWS = "name_id bigint, season string, team string, pbp_name string, canonical_name string, position string, id string, grp int"


@pytest.mark.parametrize(("name", "given", "surname"), [("Doe, John", "john", "doe"), ("John Doe Jr.", "john", "doe"), ("#12 John Q. Doe", "john", "doe"), ("JohnDoe", "john", "doe"), ("J.O'Neil", "j", "oneil"), ("De La Cruz,Ana", "ana", "delacruz"), ("Núñez", "", "nunez"), ("John Doe B", "john", "doe"), ("", "", ""), (None, "", "")])
def test_reading(name, given, surname):
    assert read_name(name)[:2] == (given, surname)


def persons(spark, rows):
    full = [(i, "s", t, n, c, p, "x", 1) for i, (t, n, c, p) in enumerate(rows)]
    groups = {}
    for r in link_names(spark.createDataFrame(full, ROWS), "name_id", ["season", "team"], "pbp_name", "canonical_name", "position").collect():
        groups.setdefault(r["person"], set()).add(r["id"])
    return sorted(map(sorted, groups.values()))


def test_linking(spark):
    rows = [
        ("A", "Thomas Ravilquez", None, "QB"), ("A", "Ravilquez,Tom", "", "QB"), ("A", "T. Ravilquez", None, "QB"), ("A", "THOMAS RAVLIQUEZ", None, None), ("A", "Thomas Ravil", None, None),  # 0-4
        ("A", "Michael Ravilquez", None, "LB"), ("A", "M. Ravilquez", "Michael Ravilquez", "LB"), ("A", "Malik Ravilquez", None, "DB"),  # 5-6, 7
        ("B", "Thomas Ravilquez", None, "QB"),  # another club
        ("A", "Ulmorin", None, None), ("A", "Kenji Ulmorin", None, None), ("A", "Ulmorin Kenji", None, None),  # 9-11
        ("A", None, None, None), ("A", " ", None, None), ("A", "Zed Quux", "Kenji Ulmorin", None),  # each by itself
    ]
    assert persons(spark, rows) == [[0, 1, 2, 3, 4], [5, 6], [7], [8], [9, 10, 11], [12], [13], [14]]


def test_short_form_of_two_people(spark):
    rows = [("A", "Joe Smithers", None, "QB"), ("A", "Jim Smithers", None, "K"), ("A", "J. Smithers", None, "K"), ("A", "Smithers", None, "WR")]
    assert persons(spark, rows) == [[0], [1, 2], [3]]


def test_repeats_and_empty(spark):
    rows = [("A", "Joe Smithers", None, "QB")] * 3
    assert persons(spark, rows) == [[0, 1, 2]]
    assert persons(spark, []) == []


def test_pairs_and_components(spark):
    p = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (4, 4)], "id bigint, person bigint")
    assert {tuple(r) for r in person_pairs(p).collect()} == {(1, 2), (1, 3), (2, 3)}
    nodes = spark.createDataFrame([(i,) for i in range(12)], "id bigint")
    chain = spark.createDataFrame([(i + 1, i) for i in range(9)], "a bigint, b bigint")
    assert {r["id"]: r["label"] for r in components(nodes, chain).collect()} == {i: 0 if i < 10 else i for i in range(12)}
