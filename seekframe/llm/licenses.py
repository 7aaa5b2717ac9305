"""Licence scan: exact set-similarity join of text blocks with templates (operator 2).

A block is a window of the whole text's words; windows overlap and are twice as
long as the longest stretch that may hold a template (twice the template's own
words), so every such stretch lies in a window, however the text wraps.  A
template matches where one stretch holds at least ``threshold`` of its distinct
words; short forms must stand whole in a stretch of their own length.  Only
words of some template can count, so windows are cut down to those first.  All
template words are put in one global order, rarest over the windows of the
whole corpus first, and three exact filters leave few pairs to compare: a block
must hold a word of the template's *prefix* (its rarest ``size - need + 1``
words, the block's prefix likewise), must be long enough (*length*), and the
words after the two matching places must still suffice (*position*).  What is
left is compared whole.  Everything is DataFrame functions.

Templates that each other's text would match (the GNU licences) are told apart
in each window by their own words and pairs of neighbouring words: one goes if
the window holds marks of the other against it and none of its own.

Templates are a parameter of bounded size (a few kB here), and so is all that
is derived from them alone: the vocabulary's frequencies, one row per template
word, are the only thing that comes to the driver.

Beside that, phrases are found at every place where their words stand
consecutively in the whole text, over line ends too.

Defined cases: null text is empty: no words, no places, labels ''; equal rows
get equal results, rows repeating a doc_id with another text stay apart; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seekframe.llm.common import WORD, ascii_lower, row_key, stored

#: Phrases of the contract and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: First sentences of public licence notices.
TEMPLATES = {
    "agpl-3.0": "licensed under the gnu affero general public license version 3",
    "apache-2.0": "licensed under the apache license version 2 0",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided "
           "that the following conditions are met",
    "cc-by-4.0": "licensed under a creative commons attribution 4 0 international license",
    "cc-by-nc-4.0": "licensed under cc by nc 4 0",
    "gpl-3.0": "licensed under the gnu general public license version 3",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is "
           "hereby granted",
    "lgpl-3.0": "licensed under the gnu lesser general public license version 3",
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
           "associated documentation files",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
}

#: Short forms, to be found word for word, and their labels.
SHORT_FORMS = {
    "under the mit license": "mit", "under the bsd license": "bsd", "under the isc license": "isc",
    "under the unlicense": "unlicense", "mozilla public license version 2 0": "mpl-2.0",
}

_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same with capitals, for text that is not lower-cased.
_BETWEEN_ANY = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _strings(xs: list[str]) -> Column:
    return F.array(*[F.lit(x) for x in xs])


def phrase_places(text: Column, phrases: dict[str, str]) -> Column:
    """Array of (start, label) of every place of every phrase; null where no phrase can stand."""
    sep = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    can = "(?i)" + "|".join(sep.join(p.split()) for p in phrases)
    longest = max(len(p.split()) for p in phrases)
    w = F.filter(F.split(ascii_lower(text), _BETWEEN), lambda x: x != "")
    # the words from each place on, as one struct, so that no lambda looks back into the array
    ahead = F.arrays_zip(*[F.slice(w, i + 1, F.greatest(F.size(w), F.lit(1))) for i in range(longest)])

    def labels_at(z: Column, i: Column) -> Column:
        hits = []
        for p, label in phrases.items():
            here = F.lit(True)
            for j, word in enumerate(p.split()):
                here &= z[str(j)] == word
            hits.append(F.when(here, F.struct(i.cast("long").alias("start"), F.lit(label).alias("label"))))
        return F.array_compact(F.array(*hits))

    return F.when(text.rlike(can), F.flatten(F.transform(ahead, labels_at)))


def _need(words: list[str], threshold: float) -> int:
    return math.ceil(threshold * len(words) - 1e-9)


def _near(scanned: DataFrame, entries: list[tuple[str, list[str], int, int]]) -> DataFrame:
    """Blocks of ``scanned`` (structs of block, words and others) with the entries (label, distinct words, words
    needed, span) that the prefix, length and position filters leave: doc_id, rk, b, words and the entry."""
    vocabulary = sorted({w for _, t, _, _ in entries for w in t})
    least = min(need for _, _, need, _ in entries)
    counts = (scanned.select(F.explode(F.flatten(F.col("blocks.words"))).alias("word"))
              .groupBy("word").agg(F.count(F.lit(1)).alias("n")))
    seen = {r["word"]: r["n"] for r in counts.collect()}            # one row per template word
    order = sorted(vocabulary, key=lambda w: (seen.get(w, 0), w))
    place = {w: i for i, w in enumerate(order)}
    ranked = [(label, sorted(t, key=place.__getitem__), need, span) for label, t, need, span in entries]
    prefixes = sorted({w for _, t, need, _ in ranked for w in t[:len(t) - need + 1]})
    heads = [F.struct(F.lit(w).alias("head"), F.lit(i + 1).alias("t_at"), F.lit(label).alias("label"),
                      F.lit(len(t)).alias("t_size"), F.lit(need).alias("need"), F.lit(span).alias("span"),
                      _strings(t).alias("t_words"))
             for label, t, need, span in ranked for i, w in enumerate(t[:len(t) - need + 1])]
    # a row per prefix word: bounded by the templates
    template = scanned.sparkSession.range(1).select(F.inline(F.array(*heads)))

    b_words = F.col("b.words")
    sized = (scanned.select("doc_id", "rk", F.explode("blocks").alias("b"))
             .filter((F.size(b_words) >= least) & F.arrays_overlap(b_words, _strings(prefixes)))
             .select("doc_id", "rk", "b", F.array_intersect(_strings(order), b_words).alias("words"))
             .withColumn("b_size", F.size("words")))
    return (sized.select("*", F.posexplode("words").alias("at", "head"))
            .join(F.broadcast(template), "head")
            .filter((F.col("b_size") >= F.col("need"))
                    & (F.col("at") + 1 <= F.col("b_size") - F.col("need") + 1)
                    & (1 + F.least(F.col("t_size") - F.col("t_at"), F.col("b_size") - F.col("at") - 1) >= F.col("need"))))


def _common() -> list[Column]:
    return [F.max("common").cast("long").alias("common"), F.max(F.col("common") / F.col("t_size")).alias("containment")]


def _entries(templates: dict[str, str], short_forms: dict[str, str], threshold: float) -> list[tuple[str, list[str], int, int]]:
    """(label, distinct words, words needed, words of a stretch) of templates and short forms."""
    entries = [(label, t.lower().split(), threshold, 2) for label, t in templates.items()]
    entries += [(label, p.lower().split(), 1.0, 1) for p, label in short_forms.items()]
    return [(label, list(dict.fromkeys(ws)), _need(list(dict.fromkeys(ws)), least), times * len(ws)) for label, ws, least, times in entries]


def scan_licenses(docs: DataFrame, *, templates: dict[str, str] = TEMPLATES, short_forms: dict[str, str] = SHORT_FORMS,
                  phrases: dict[str, str] = PHRASES, threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(documents, matches): per row of ``docs`` its words and phrase places; per matching window and template
    the number of the window's first word, the most words in common and the containment."""
    entries = _entries(templates, short_forms, threshold)
    vocabulary = sorted({w for _, t, _, _ in entries for w in t})
    step = max(span for _, _, _, span in entries)
    text = F.coalesce("text", F.lit(""))
    every = F.filter(F.split(text, _BETWEEN_ANY), lambda w: w != "")

    def window(s: Column) -> Column:
        """Template words from word ``s`` on, with their places in the text."""
        seq = F.transform(F.slice("every", s + 1, 2 * step), lambda w, i: F.struct((s + i).alias("at"), F.lower(w).alias("word")))
        return F.struct(s.alias("block"), F.filter(seq, lambda x: x["word"].isin(vocabulary)).alias("seq"))

    starts = F.sequence(F.lit(0), F.greatest(F.size("every") - 1, F.lit(0)), F.lit(step))
    windows = F.transform(starts, window)
    least = min(need for _, _, need, _ in entries)
    blocks = F.transform(F.filter("windows", lambda b: F.size(b["seq"]) >= least), lambda b: F.struct(
        b["block"].alias("block"), F.array_distinct(b["seq"]["word"]).alias("words"), b["seq"].alias("seq")))
    scanned = stored(
        docs.select("doc_id", row_key().alias("rk"), text.alias("text"), every.alias("every"))
        .select("doc_id", "rk", "text", F.size("every").cast("long").alias("n_words"), windows.alias("windows"))
        .select("doc_id", "rk", "n_words", phrase_places(F.col("text"), phrases).alias("places"), blocks.alias("blocks")),
        "windows")

    pairs = _near(scanned, entries).dropDuplicates(["doc_id", "rk", "b", "label", "t_words"])
    own = F.filter("b.seq", lambda x: F.array_contains(F.col("t_words"), x["word"]))
    # most different template words in a stretch that starts with one of them
    stretches = F.transform("own", lambda x: F.size(F.array_distinct(F.transform(
        F.filter("own", lambda y: (y["at"] >= x["at"]) & (y["at"] < x["at"] + F.col("span"))), lambda y: y["word"]))))
    found = (pairs.withColumn("own", own).withColumn("common", F.array_max(stretches))
             .filter(F.col("common") >= F.col("need"))
             .groupBy("doc_id", "rk", "b", "label").agg(*_common())
             .groupBy("doc_id", "rk", "b").agg(F.collect_list(F.struct("label", "common", "containment")).alias("got")))
    matches = (found.select("doc_id", "rk", F.col("b.block").alias("block"), F.col("got.label").alias("labels"),
                            _marks_of(F.col("b.seq")).alias("marks"), F.explode("got").alias("m"))
               .select("doc_id", "rk", "block", "labels", "marks", "m.*")
               .filter(~_beaten(templates, threshold)).drop("labels", "marks"))
    return scanned.select("doc_id", "rk", "n_words", "places"), matches


def _marks_of(seq: Column) -> Column:
    """Words of a window and pairs of neighbouring words."""
    after = F.slice(seq, 2, F.greatest(F.size(seq) - 1, F.lit(0)))
    pairs = F.zip_with(F.slice(seq, 1, F.greatest(F.size(seq) - 1, F.lit(0))), after, lambda x, y: F.when(
        y["at"] == x["at"] + 1, F.concat_ws(" ", x["word"], y["word"])))
    return F.array_union(seq["word"], F.array_compact(pairs))


def _rivals(templates: dict[str, str], threshold: float) -> list[tuple[str, str, list[str], list[str]]]:
    """(label, rival, marks of the label alone, marks of the rival alone) of templates that each other's text would match."""
    words = {label: t.lower().split() for label, t in templates.items()}
    marks = {label: [*dict.fromkeys(ws), *dict.fromkeys(map(" ".join, zip(ws, ws[1:])))] for label, ws in words.items()}
    out = []
    for x, wx in words.items():
        for y, wy in words.items():
            if x != y and len({*wx} & {*wy}) >= min(_need([*{*wx}], threshold), _need([*{*wy}], threshold)):
                own, other = ([m for m in marks[p] if m not in marks[q]] for p, q in ((x, y), (y, x)))
                if other:
                    out.append((x, y, own, other))
    return out


def _beaten(templates: dict[str, str], threshold: float) -> Column:
    """Whether a row (label, labels of its window, marks) has a rival there with marks against it and none of its own."""
    beaten = F.lit(False)
    for label, rival, own, other in _rivals(templates, threshold):
        lost = F.arrays_overlap("marks", _strings(other))
        if own:
            lost &= ~F.arrays_overlap("marks", _strings(own))
        beaten |= (F.col("label") == label) & F.array_contains("labels", rival) & lost
    return beaten


def licenses_digest(docs: DataFrame) -> DataFrame:
    return _digest(*scan_licenses(docs))


def _digest(scanned: DataFrame, matches: DataFrame) -> DataFrame:
    found = (matches.groupBy(F.col("doc_id").alias("m_id"), F.col("rk").alias("m_rk"))
             .agg(F.collect_set("label").alias("found"), F.max("containment").alias("best")))
    places = F.coalesce("places", F.expr("cast(array() as array<struct<start:bigint,label:string>>)"))
    base = F.array_sort(F.array_distinct(F.col("p.label")))
    none = F.expr("cast(array() as array<string>)")
    return (scanned.join(found, F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("rk") == F.col("m_rk")), "left")
            .withColumn("p", places)
            .select("doc_id", "n_words", F.size("p").cast("long").alias("n_base"),
                    F.array_min("p.start").alias("first_word"), F.array_max("p.start").alias("last_word"),
                    F.array_join(base, ",").alias("base_labels"),
                    F.array_join(F.array_sort(F.array_union(base, F.coalesce("found", none))), ",").alias("labels"),
                    F.when(F.size("p") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score")))


def licenses_sql() -> str:
    entries = _entries(TEMPLATES, SHORT_FORMS, 0.8)
    step = max(span for _, _, _, span in entries)
    rows = ",\n  ".join(f"('{label}', {len(t)}, {t!r}, {need}, {span})" for label, t, need, span in entries)
    rivals = ",\n  ".join(f"('{x}', '{y}', {own!r}::VARCHAR[], {other!r})" for x, y, own, other in _rivals(TEMPLATES, 0.8))
    vocabulary = sorted({w for _, t, _, _ in entries for w in t})
    phrases = ",\n  ".join(f"('{label}', {p.split()!r})" for p, label in PHRASES.items())
    return rf"""
WITH template(label, size, words, need, span) AS (VALUES
  {rows}
), rival(label, rival, own, other) AS (VALUES
  {rivals}
), phrase(label, words) AS (VALUES
  {phrases}
), d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w
  FROM documents
), place AS (
  SELECT r, p.label, unnest(list_filter(range(len(w)), lambda i: w[i + 1:i + len(p.words)] = p.words)) AS start
  FROM d, phrase p WHERE contains(array_to_string(w, ' '), array_to_string(p.words, ' '))
), base AS (
  SELECT r, count(*) AS n, min(start) AS lo, max(start) AS hi, list_sort(list(DISTINCT label)) AS labels FROM place GROUP BY r
), word AS (
  SELECT r, unnest(w) AS word, unnest(range(len(w))) AS pos FROM d
), own AS (
  SELECT * FROM word WHERE word IN ({", ".join(map(repr, vocabulary))})
), win AS (
  -- every word stands in the window that starts at or before it and in the one before that
  SELECT r, (pos // {step} - k) * {step} AS block, list({{'pos': pos, 'word': word}} ORDER BY pos) AS seq
  FROM own, (VALUES (0), (1)) v(k) WHERE pos // {step} >= k GROUP BY ALL
), pair AS (
  SELECT r, block, label, size, need, span, seq, list_filter(seq, lambda x: list_contains(words, x.word)) AS mine
  FROM win, template WHERE len(list_intersect(list_transform(seq, lambda x: x.word), words)) >= need
), best AS (
  SELECT r, block, label, size, need, seq, list_max(list_transform(mine, lambda x: len(list_distinct(list_transform(
         list_filter(mine, lambda y: y.pos >= x.pos AND y.pos < x.pos + span), lambda y: y.word))))) AS common FROM pair
), hit AS (
  SELECT r, block, label, seq, max(common / size) AS c FROM best WHERE common >= need GROUP BY ALL
), told AS (
  SELECT h.*, list(label) OVER (PARTITION BY r, block) AS labels,
         list_concat(list_transform(seq, lambda x: x.word), list_transform(list_filter(range(1, len(seq)), lambda i: seq[i + 1].pos = seq[i].pos + 1),
                     lambda i: seq[i].word || ' ' || seq[i + 1].word)) AS marks FROM hit h
), m AS (
  SELECT r, list(DISTINCT label) AS labels, max(c) AS best FROM told t
  WHERE NOT EXISTS (SELECT 1 FROM rival v WHERE v.label = t.label AND list_contains(t.labels, v.rival)
                    AND list_has_any(t.marks, v.other) AND NOT list_has_any(t.marks, v.own)) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, lo::BIGINT AS first_word, hi::BIGINT AS last_word,
       coalesce(array_to_string(base.labels, ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(m.labels, [])))), ','), '') AS labels,
       CASE WHEN n > 0 THEN 1.0 ELSE coalesce(best, 0.0) END::DOUBLE AS score
FROM d LEFT JOIN base USING (r) LEFT JOIN m USING (r)
"""
