"""Normalisation of disguised words, and the classifier on sentences it hasn't seen."""

import pytest

from fieldlog.llm import abuse
from fieldlog.llm.abuse import language, normalise, score_documents, segments, train

SEEN = None


@pytest.mark.parametrize(("text", "want"), [("f u c k you", "fuck you"), ("f.u.c.k off", "fuck off"), ("mooooron", "moron"), ("b@$t@rd", "bastard"), ("id10t", "idiot"), ("na-ked", "naked"), ("b*****d", "bastard"), ("t​i​ts", "tits"), ("<p>Hi&nbsp;there</p>", "hi there"), ("IMBÉCIL", "imbecil"), ("a 7-14 win", "a 7-14 win")])
def test_normalise(text, want):
    assert normalise(text).strip() == want


def test_segments_and_language():
    assert segments(None) == segments("") == segments("... !!") == []
    assert len(segments("word " * 5000)) > 200
    assert language(segments("la gente y el equipo de la casa"), None) == "es"
    assert language(segments("the people and the team of this house"), "es") == "en"
    assert language([], None) == "en"


def test_unseen_sentences():
    net, limits = train([])
    score = lambda t: max(float(x) for x in net.score(segments(t)))
    for t in ("Okoro you are a filthy 1diot, get off this team", "somebody should break his legs tonight", "those refugees are vermin, send them all back", "send nudes tonight, I want to have sex with you", "ojalá que Okoro se muera", "eres un imb3cil de m*****"):
        assert score(t) >= limits["en"], t
    for t in ("holy shit what a catch", "I am such an idiot, I lost my ticket", "the club condemns racism and threats", "he killed the drive with a sack", "qué idiota soy, perdí la llave"):
        assert score(t) < limits["en"], t


def test_documents(spark):
    docs = [(1, None, None, None, "x"), (2, "", "en", "s", "x"), (3, "you are a worthless piece of shit. " + "nice day. " * 3000, "en", "s", "x"), (4, "gates open at noon", None, "s", "x")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, score string")
    labels = spark.createDataFrame([(4, "a", "keep"), (3, "a", "remove"), (None, "a", "keep"), (2, "b", None)], "doc_id bigint, rater string, verdict string")
    got = {r["doc_id"]: (r["score"], r["flagged"]) for r in score_documents(df, labels).collect()}
    assert got[1] == got[2] == (0.0, False)
    assert got[3][1]
    assert not got[4][1]
    assert score_documents(df.limit(0), labels.limit(0)).collect() == []


def test_verdicts_are_read_whole(spark, monkeypatch):
    fitted = next(k for k in range(1, 99) if not abuse.held_out(k))
    docs = [(k, "nice day. " * 300 + "you are a worthless piece of shit.", "en", "s") for k in range(1, 41)] + [(fitted + 1000, None, "en", "s")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string")
    labels = spark.createDataFrame([(d[0], "a", "remove") for d in docs], "doc_id bigint, rater string, verdict string")
    # Fitting takes whole documents, as many as fit; the end of a long text is there.
    monkeypatch.setattr(abuse, "SEGMENTS", 1000)
    sample = abuse.labelled_segments(df, labels)
    assert [len(d[3]) for d in sample] == [301] * 3
    assert not any(abuse.held_out(d[0]) for d in sample)
    # All other verdicts calibrate, and by the worst segment wherever it stands.
    counts = abuse.held_counts(abuse.fit([]), df, labels, [d[0] for d in sample])
    assert sum(counts.values()) == len(docs) - len(sample)
    assert sum(n for (_, level, y), n in counts.items() if level == len(abuse.CUTS) and y) == 40 - len(sample)


def test_thresholds_of_counts():
    # 200 removed documents at 0.6 and no kept one above 0.5: the cut-off goes most of the way down to where F1 is best.
    low = abuse.thresholds({("en", 3, 1): 200, ("en", 0, 0): 900})
    assert low["es"] == abuse.USUAL
    assert low["en"] == pytest.approx(0.8 + 0.8 * (0.6 - 0.8))


def test_seeds_are_not_taken_from_the_corpus(folder):
    """No four words in a row of a written sentence occur in the test documents."""
    import re
    from pathlib import Path

    import pyarrow.parquet as pq

    from fieldlog.llm import abuse_seeds as seeds

    word = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
    fours = lambda w: {tuple(w[i : i + 4]) for i in range(len(w) - 3)}
    own = {f for pool in (seeds.ABUSE, seeds.ABUSE_ES, seeds.FAIR, seeds.FAIR_ES) for line in pool.split("\n") for run in re.split(r"\{\w\}", line) for f in fours(word.findall(run.lower()))}
    seen = set()
    for at in sorted({folder, *(str(p) for p in Path(folder).parent.glob("sf*"))}):
        for t in pq.read_table(f"{at}/documents.parquet", columns=["text"])["text"].to_pylist():
            seen |= fours(word.findall((t or "").lower())) & own
    assert seen == set()
