import pytest
from llm_fixtures import no_docs, odd_docs  # noqa: F401

from hearth.llm import license_texts as T
from hearth.llm import licenses as N


def scan(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in N.scan(df).collect()}


def test_base_places(spark):
    got = scan(spark, ["All rights reserved, cc-by. ALL RIGHTS RESERVED", "cc / by", "general public licenses", "general, public\nLICENSE x",
                       "all rights", None, ""])
    assert (got[0].n_words, got[0].n_base, got[0].first_word, got[0].last_word, got[0].base_labels) == (8, 3, 0, 5, "cc-by,reserved")
    assert got[0].score == 1.0
    assert (got[1].base_labels, got[1].n_base) == ("cc-by", 1) and got[2].base_labels == "" and got[2].score == 0
    assert (got[3].base_labels, got[3].first_word) == ("gpl", 0)
    for i in (4, 5, 6):
        assert (got[i].n_base, got[i].first_word, got[i].last_word, got[i].base_labels, got[i].labels, got[i].score) == (0, None, None, "", "", 0.0)


def test_notices_with_changes(spark):
    bsd = dict(N.NOTICES)["bsd"]
    words = bsd.split()
    changed = " ".join(words[:6] + ["extra"] + words[6:12] + words[13:])
    got = scan(spark, [f"x y {bsd} z", f"x {changed} y", " ".join(words[:8]), "Released under the MIT License.",
                       "Licensed under CC BY-NC 4.0."])
    assert got[0].labels == "bsd" and got[0].score == 1.0 and got[0].base_labels == ""
    assert got[1].labels == "bsd" and N.COVER <= got[1].score < 1
    assert got[2].labels == "" and got[2].score == 0
    assert got[3].labels == "mit" and got[4].labels == "cc-by,cc-by-nc-4.0"


def test_whole_licences_and_own_templates(spark):
    texts = dict(T.TEXTS)
    changed = texts["mit"].replace("The above", "The   following").replace("AUTHORS", "WRITERS")
    got = scan(spark, [f"Copyright (c) 2020 A. N. Other\n\n{text}\nmore" for text in texts.values()] + [changed, texts["isc"][:200]])
    for i, label in enumerate(texts):
        own = set(got[i].labels.split(",")) - set(got[i].base_labels.split(","))
        assert own == {label} and got[i].score == 1.0, label
    assert got[len(texts)].labels == "mit" and got[len(texts) + 1].labels == ""
    df = spark.createDataFrame([(1, "we part as friends today"), (2, texts["mit"])], "doc_id long, text string")
    own = {r.doc_id: r.labels for r in N.scan(df, templates=[("house", "part as friends"), ("none", "..")]).collect()}
    assert own == {1: "house", 2: ""}
    with pytest.raises(ValueError):
        N.Grams([("short", "word")])


def test_spans_say_where(spark):
    df = spark.createDataFrame([(1, "a b released under the mit license c")], "doc_id long, text string")
    found = [(r.label, r.start, r.end, r.cover) for r in N.spans(df).collect() if r.label == "mit" and r.cover == 1]
    assert found == [("mit", 2, 7, 1.0)]


def test_odd_rows(spark, odd_docs, no_docs):  # noqa: F811
    got = N.scan(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by = {r.doc_id: r for r in got}
    assert by[11].base_labels == "cc-by,reserved" and by[11].labels == "cc-by,cc-by-nc-4.0,reserved"
    assert by[5].n_words == 80_000 and by[None].n_words == 6
    assert sum(r.doc_id == 7 for r in got) == 2
    assert N.scan(no_docs).count() == 0
