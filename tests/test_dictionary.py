"""Vocabulary indexes and searches over postings against the clauses over documents."""

import random

import pytest

from seekframe import Index, Mapping, Match, MatchPhrase, MatchPhrasePrefix, Wildcard, matching
from seekframe.functions.scoring import bm25_py
from seekframe.operators.dictionary import (build_dictionary, deletions, fuzzy_stored, fuzzy_terms, pattern_grams, phrase_prefix_stored,
                                            phrase_stored, prefix_terms, read_dictionary, wildcard_stored, wildcard_terms, write_dictionary)
from seekframe.operators.postings import build_tables
from seekframe.session import checkpoint_dir


@pytest.fixture(scope="module")
def setup(spark):
    rng = random.Random(9)
    words = ["".join(rng.choices("abc", k=rng.randint(1, 6))) for _ in range(120)] + ["a", "bb", "straße", "日本"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 30)) + rng.choices(["to", "be", "to be", "to be to be to"], k=rng.randint(0, 3))))
            for i in range(150)] + [(200, None), (201, "")]
    ix = Index(spark.createDataFrame(rows, "id long, body string"), Mapping().long("id").text("body"), id_col="id")
    tables = build_tables(ix, ["body"])
    path = f"{checkpoint_dir(spark)}/dictionary-test"
    return ix, tables, write_dictionary(build_dictionary(tables.term_stats), path), path, sorted(set(words) | {"to", "be"})


def rows(df):
    return sorted((r["_id"], r["_score"]) for r in df.select("_id", "_score").collect())


def vocabulary(tables):
    return {r["term"] for r in tables.term_stats.select("term").collect()}


@pytest.mark.parametrize("pattern", ["ab*", "*ab", "*bc*a*", "a?c", "?", "*", "a*", "*c", "abc", "??b*", "stra*e", "*本", "", "zz*"])
def test_wildcard_terms(setup, pattern):
    import fnmatch
    import re

    _, tables, d, _, _ = setup
    want = {t for t in vocabulary(tables) if re.fullmatch(fnmatch.translate(pattern), t)}
    assert {r["term"] for r in wildcard_terms(d, "body", pattern).collect()} == want


def test_pattern_grams_keep_marks():
    assert pattern_grams("a*") == ["\x02a"] and pattern_grams("*abc*") == ["abc"] and pattern_grams("*") == []
    assert pattern_grams("ab?") == ["\x02ab"]


def test_wildcards_and_prefixes_equal_the_clauses(setup):
    ix, tables, d, _, _ = setup
    for pattern in ("ab*", "*ca*", "b?c*"):
        assert rows(wildcard_stored(tables, d, "body", pattern, boost=2.0)) == rows(matching(ix, Wildcard("body", pattern, boost=2.0)))
    assert {r["term"] for r in prefix_terms(d, "body", "ab").collect()} == {t for t in vocabulary(tables) if t.startswith("ab")}
    for text in ("to b", "be to", "a", "to be to"):
        assert rows(phrase_prefix_stored(tables, d, "body", text)) == rows(matching(ix, MatchPhrasePrefix("body", text)))


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_fuzzy_terms_by_deletions(setup):
    _, tables, d, path, words = setup
    assert deletions("abc", 1) == ["ab", "abc", "ac", "bc"] and deletions("a", 2) == ["", "a"]
    again = read_dictionary(tables.postings.sparkSession, path)
    for word in ("abc", "aabbc", "strase", "b", "zzz"):
        for k in (0, 1, 2):
            want = {t for t in vocabulary(tables) if edits(word, t) <= k}
            assert {r["term"] for r in fuzzy_terms(again, "body", word, k).collect()} == want
    assert {r["term"] for r in fuzzy_terms(d, "body", "abc", 2, prefix_length=2).collect()} \
        == {t for t in vocabulary(tables) if t[:2] == "ab" and edits("abc", t) <= 2}
    assert fuzzy_terms(d, "body", "abc", 2, max_expansions=3).count() == 3
    with pytest.raises(ValueError):
        fuzzy_terms(d, "body", "abc", 3)


def test_fuzzy_scores_every_expansion(setup):
    ix, tables, d, _, _ = setup
    docs = {r["_id"]: (r["body"] or "").split() for r in ix.df.select("_id", "body").collect()}
    present = [i for i in docs if i != "200"]
    avg = sum(map(len, docs.values())) / len(present)
    df = {t: sum(t in w for w in docs.values()) for t in vocabulary(tables)}
    for query, operator in (("abca bcab", "or"), ("abca bcab", "and"), ("strasse", "or")):
        want = []
        for i in present:
            parts, hit = 0.0, 0
            for q in dict.fromkeys(query.split()):
                ex = [t for t in df if edits(q, t) <= (1 if len(q) < 6 else 2) and t in docs[i]]
                hit += bool(ex)
                parts += sum(bm25_py(docs[i].count(t), len(docs[i]), len(present), df[t], avg) for t in ex)
            if hit == 2 or hit and operator == "or":
                want.append((i, round(parts, 6)))
        assert rows(fuzzy_stored(tables, d, "body", query, operator=operator)) == sorted(want)
        assert rows(matching(ix, Match("body", query, fuzziness="AUTO", operator=operator))) == sorted(want)


def test_phrases_from_positions(setup):
    ix, tables, _, _, _ = setup
    for text in ("to be", "to be to", "be to be to be", "to", "to to", "no such"):
        assert rows(phrase_stored(tables, "body", text)) == rows(matching(ix, MatchPhrase("body", text)))
    assert phrase_stored(tables, "body", "  ").count() == 0


def test_fuzzy_terms_of_long_words(spark):
    """The variants cover the beginnings of words; edits fall anywhere."""
    rng = random.Random(5)
    base = ["".join(rng.choices("abcd", k=rng.randint(5, 14))) for _ in range(40)]

    def changed(w):
        for _ in range(rng.randint(0, 3)):
            i, c = rng.randrange(len(w) + 1), rng.choice("abcd")
            w = rng.choice([w[:i] + c + w[i:], w[:i] + w[i + 1:], w[:i] + c + w[i + 1:]])
        return w

    words = sorted({changed(w) for w in base for _ in range(15)})
    stats = spark.createDataFrame([("body", w, 1) for w in words], "field string, term string, df long")
    d = write_dictionary(build_dictionary(stats), f"{checkpoint_dir(spark)}/dictionary-long")
    assert d.variants.groupBy("term").count().agg({"count": "max"}).first()[0] <= 22
    for w in base[:6] + [changed(w) for w in base[6:12]]:
        for k in (1, 2):
            assert {r["term"] for r in fuzzy_terms(d, "body", w, k).collect()} == {t for t in words if edits(w, t) <= k}
