import zlib

from pyspark.sql import functions as F

from llm_fixtures import no_docs, odd_docs  # noqa: F401

from hearth.llm import language as L

from conftest import SF_SMALL

FOLD = L.folding()


def brute_grams(text):
    """Counts of 1- to 3-letter n-grams, words padded with one blank each side."""
    words = "".join(c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else " " for c in text).split()
    out = {}
    for g in (g for w in words for g in w):
        out[g] = out.get(g, 0) + 1
    line = " " + " ".join(words) + " "
    for i in range(len(line) - 1):
        out[line[i:i + 2]] = out.get(line[i:i + 2], 0) + 1
    for i in range(len(line) - 2):
        if line[i + 1] != " ":
            out[line[i:i + 3]] = out.get(line[i:i + 3], 0) + 1
    return out


def name(number):
    places = [number >> 42 & 0x1FFFFF, number >> 21 & 0x1FFFFF, number & 0x1FFFFF]
    return "".join(" " if p == 1 else chr(p) for p in places if p)


def test_grams_match_a_plain_count():
    for text in ["a", "The cat, the HAT!", " été -- x1y ", "日本 語", "ß", "İstanbul a"]:
        got = {}
        for g in L.grams(text, FOLD):
            got[name(int(g))] = got.get(name(int(g)), 0) + 1
        assert got == brute_grams(text), text
    assert len(L.grams("12 .. 3", FOLD)) == 0


def test_out_of_place_distance_by_hand():
    def profile(text):
        return [int(g) for g in L.top_grams(text, 5, FOLD)]
    scorer = L.Scorer({"one": profile("aaa bbb"), "two": profile("xyz xyz")}, 5)
    own = [int(g) for g in L.top_grams("aaa bb", 5, FOLD)]
    cost = {n: sum(abs(p.index(g) - i) if g in p else 5 for i, g in enumerate(own))
            for n, p in (("one", profile("aaa bbb")), ("two", profile("xyz xyz")))}
    lang, score = scorer.best("aaa bb")
    assert lang == min(cost, key=cost.get) == "one"
    assert abs(score - (1 - cost["one"] / (5 * len(own)))) < 1e-12


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = L.held_out(F.col("doc_id"), 3, 1)
    found = L.identify(docs.select("doc_id", "text", "lang"), L.train(docs, ~held)).filter(held).collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 0.97 * len(found)


def test_training_counts_all_rows(spark):
    docs = spark.createDataFrame([(i, "ab ab c", "x") for i in range(50)] + [(99, None, "x"), (98, "zzz", None)],
                                 "doc_id long, text string, lang string").repartition(7)
    got = {name(r.gram): r.n for r in L.count_grams(docs.filter("text is not null and lang is not null")).collect()}
    assert got == {g: 50 * n for g, n in brute_grams("ab ab c").items()}


def test_odd_rows(spark, odd_docs, no_docs):
    profiles = L.train(odd_docs)
    assert set(profiles) == {"en", "fr", "de", "ja"}
    got = L.identify(odd_docs, profiles)
    assert got.columns == [*odd_docs.columns, "lang_pred", "lang_score"]
    for r in got.collect():
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and 0 <= r.lang_score <= 1
    assert L.keep_identified(odd_docs).columns == odd_docs.columns
    assert L.keep_identified(odd_docs).filter("text is null or text = ''").count() == 0
    assert L.train(no_docs) == {} and L.keep_identified(no_docs).count() == 0
    assert {r.lang_pred for r in L.identify(odd_docs, {}).collect()} == {"und"}


def test_query_columns(spark):
    from hearth.llm.queries import QUERIES
    df = QUERIES["op4_language_id"](spark, SF_SMALL)
    assert df.columns == ["doc_id", "held_out", "lang_pred", "score"] and df.count() == 200


def test_no_labelled_row_keeps_every_text_with_a_letter(spark, odd_docs, no_docs):
    docs = odd_docs.withColumn("lang", F.lit(None).cast("string"))
    kept = L.keep_identified(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.select("doc_id").collect()) == sorted(map(str, [5, 6, 7, 7, 8, None, 10, 11, 12, 13]))
    assert L.keep_identified(no_docs).count() == 0


def number(gram):
    """The place of an n-gram in the order that breaks ties."""
    out = 0
    for c in gram:
        out = out << 21 | (1 if c == " " else ord(c))
    return out


def brute_predictions(rows, size=L.PROFILE):
    """{doc_id: (language, score)}: profiles from the rows that are not held out,
    out-of-place distances one n-gram at a time."""
    counts = {}
    for doc_id, text, lang in rows:
        if text and lang is not None and zlib.crc32(str(doc_id).encode()) % 3 != 1:
            for g, n in brute_grams(text).items():
                counts.setdefault(lang, {})[g] = counts.get(lang, {}).get(g, 0) + n

    def ranked(grams):
        return sorted((g for g in grams if g.strip()), key=lambda g: (-grams[g], number(g)))[:size]

    profiles = {lang: {g: i for i, g in enumerate(ranked(c))} for lang, c in counts.items()}
    out = {}
    for doc_id, text, _ in rows:
        own = ranked(brute_grams(text)) if text else []
        best = min(((sum(abs(p[g] - i) if g in p else size for i, g in enumerate(own)), lang) for lang, p in profiles.items()),
                   default=None) if own else None
        out[doc_id] = ("und", 0.0) if best is None else (best[1], 1 - best[0] / (size * len(own)))
    return out


def test_query_against_brute_force(spark):
    from hearth.llm.queries import QUERIES
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    want = brute_predictions(rows)
    got = {r.doc_id: r for r in QUERIES["op4_language_id"](spark, SF_SMALL).collect()}
    assert len(got) == len(rows)
    for doc_id, (lang, score) in want.items():
        assert got[doc_id].lang_pred == lang and abs(got[doc_id].score - score) < 1e-9, doc_id
        assert got[doc_id].held_out == (zlib.crc32(str(doc_id).encode()) % 3 == 1)
