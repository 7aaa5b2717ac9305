"""Highlight fragments (no SQL oracle) against a brute-force Python fragmenter."""

import regex
from pyspark.sql import functions as F

from seekframe.functions.analysis import WORD_CLASS
from seekframe.functions.highlight import HighlightField, highlight_column

TEXTS = [
    "The ering was here. Then retion came, and ering again! Nothing else? Final ering words here now.",
    "no hits in this one at all",
    "ering " * 30,
    "short retion",
]
TERMS = ["ering", "retion"]


def py_hits(terms):
    return regex.compile(rf"(?iu)(?<!{WORD_CLASS})(?:{'|'.join(terms)})(?!{WORD_CLASS})")


def py_fragments(text, scanner, size):
    if scanner == "sentence":
        return [s for s in regex.split(r"(?<=[.!?])\s+", text) if s.strip(" ")]
    m = max(0, size - 2)
    return regex.findall(rf"(?s)\S(?:.{{0,{m}}}\S)?(?=\s|$)|\S{{1,{size}}}", text)


def brute(text, scanner=None, size=100, n=5, order="none"):
    hit = py_hits(TERMS)
    frags = [f for f in py_fragments(text, scanner, size) if hit.search(f)]
    if order == "score":
        frags = [f for _, _, f in sorted((-len(hit.findall(f)), i, f) for i, f in enumerate(frags))]
    frags = frags[:n]
    if not frags:
        return None
    return [hit.sub(lambda mo: "<em>" + mo.group(0) + "</em>", f) for f in frags]


def run(spark, hf):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    out = df.select("i", highlight_column(F.col("t"), TERMS, [], hf).alias("h")).orderBy("i").collect()
    return [r["h"] for r in out]


def test_default_fragments(spark):
    got = run(spark, HighlightField("t", fragment_size=30, number_of_fragments=3))
    assert got == [brute(t, None, 30, 3) for t in TEXTS]


def test_sentence_fragments(spark):
    got = run(spark, HighlightField("t", boundary_scanner="sentence", number_of_fragments=2))
    assert got == [brute(t, "sentence", 100, 2) for t in TEXTS]


def test_score_order(spark):
    got = run(spark, HighlightField("t", fragment_size=25, number_of_fragments=2, order="score"))
    assert got == [brute(t, None, 25, 2, "score") for t in TEXTS]


def test_whole_field_and_no_match_size(spark):
    got = run(spark, HighlightField("t", number_of_fragments=0, no_match_size=5))
    hit = py_hits(TERMS)
    want = [[hit.sub(lambda mo: "<em>" + mo.group(0) + "</em>", t)] if hit.search(t) else [t[:5]] for t in TEXTS]
    assert got == want


def marked(spark, text, query, **opts):
    from seekframe import Highlight, Index, Mapping, search

    ix = Index(spark.createDataFrame([(1, text)], "id long, t string"), Mapping().long("id").text("t"), id_col="id")
    hits = search(ix, query, highlight=Highlight(number_of_fragments=0).field("t", **opts)).hits.collect()
    return hits[0]["_highlight"].get("t", [None])[0] if hits else None


def test_only_words_of_the_phrase_are_tagged(spark):
    from seekframe import Bool, Match, MatchPhrase, MatchPhrasePrefix, MultiMatch

    text = "Of a kind: the end of the day, of\nthe night; the of."
    want = "Of a kind: the end <em>of</em> <em>the</em> day, <em>of</em>\n<em>the</em> night; the of."
    assert marked(spark, text, MatchPhrase("t", "of the")) == want
    assert marked(spark, text, MultiMatch("of the", ["t"], type="phrase")) == want
    # occurrences that overlap, and one word that other clauses tag everywhere
    assert marked(spark, "to be to be to go", MatchPhrase("t", "to be to")) \
        == "<em>to</em> <em>be</em> <em>to</em> <em>be</em> <em>to</em> go"
    both = Bool(should=[Match("t", "the"), MatchPhrase("t", "of the")])
    assert marked(spark, text, both) == ("Of a kind: <em>the</em> end <em>of</em> <em>the</em> day, <em>of</em>\n<em>the</em> night; "
                                         "<em>the</em> of.")
    assert marked(spark, "the endless ends of the end", MatchPhrasePrefix("t", "the end")) \
        == "<em>the</em> <em>endless</em> ends of <em>the</em> <em>end</em>"
    assert marked(spark, "the end", MatchPhrase("t", "end")) == "the <em>end</em>"


def test_phrases_in_long_texts_and_fragments(spark):
    from seekframe.functions.highlight import HighlightField, highlight_column

    text = "one two three. " * 2000 + "two one. " + "one two. " * 3
    df = spark.createDataFrame([(text,)], "t string")
    hf = HighlightField("t", boundary_scanner="sentence", number_of_fragments=2)
    got = df.select(highlight_column(F.col("t"), [], [], hf, phrases=[(("two", "one"), False)]).alias("h")).first()["h"]
    assert got == ["<em>two</em> <em>one</em>."]
