"""Highlighting as Column builders.

Given the terms a query looks for in a field, ``highlight_column`` returns an
``array<string>`` of fragments with every hit wrapped in tags.  It is applied
to the rows of a result *page* (after the top-k), so its regex work is
proportional to the page, never to the index.

Fragments (our definition; see README "decisions"):

* default / ``word``: greedy chunks of at most ``fragment_size`` characters
  that end at a word end;
* ``sentence``: sentences split after ``.``, ``!`` or ``?``;
* ``chars``: ``fragment_size`` characters, extended by at most
  ``boundary_max_scan`` characters up to the next boundary character;
* ``number_of_fragments = 0``: the whole field is one fragment.

Only fragments holding a hit are kept (``order='score'`` sorts them by hit
count, ties by position), then the first ``number_of_fragments``.  Without a
hit the field gives ``no_match_size`` leading characters, or nothing.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from .analysis import WORD_CLASS

# Defaults of the highlighter.
DEFAULT_PRE_TAGS = ("<em>",)
DEFAULT_POST_TAGS = ("</em>",)
DEFAULT_FRAGMENT_SIZE = 100
DEFAULT_NUMBER_OF_FRAGMENTS = 5
DEFAULT_BOUNDARY_CHARS = ".,!? \t\n"
DEFAULT_BOUNDARY_MAX_SCAN = 20
SENTENCE_TAG = "<mark>"


@dataclass
class HighlightField:
    name: str
    fragment_size: int | None = None
    number_of_fragments: int | None = None
    boundary_scanner: str | None = None
    boundary_chars: str | None = None
    boundary_max_scan: int | None = None
    order: str | None = None
    no_match_size: int | None = None
    highlight_query: Any = None
    matched_fields: list[str] = field(default_factory=list)
    pre_tags: list[str] | None = None
    post_tags: list[str] | None = None


@dataclass
class Highlight:
    fields: list[HighlightField] = field(default_factory=list)
    pre_tags: list[str] | None = None
    post_tags: list[str] | None = None
    highlight_query: Any = None
    fragment_size: int | None = None
    number_of_fragments: int | None = None
    order: str | None = None

    def field(self, name: str, **opts) -> "Highlight":
        self.fields.append(HighlightField(name, **opts))
        return self

    def add_fields(self, entries: list[dict]) -> "Highlight":
        for e in entries or []:
            e = dict(e)
            self.fields.append(HighlightField(e.pop("name"), **e))
        return self

    def tags(self, pre: list[str], post: list[str]) -> "Highlight":
        self.pre_tags, self.post_tags = list(pre), list(post)
        return self

    def query(self, q) -> "Highlight":
        self.highlight_query = q
        return self


def _quote(term: str) -> str:
    if re.fullmatch(r"\w+", term):
        return term
    return "\\Q" + term.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def _wildcard_regex(pat: str) -> str:
    out = []
    for ch in pat:
        if ch == "*":
            out.append(WORD_CLASS + "*")
        elif ch == "?":
            out.append(WORD_CLASS)
        else:
            out.append(_quote(ch) if not ch.isalnum() else ch)
    return "".join(out)


def hit_regex(terms: list[str], patterns: list[str] = ()) -> str | None:
    """Java regex matching any of the terms as a whole word, case-insensitively."""
    alts = [_quote(t) for t in terms] + [_wildcard_regex(p) for p in patterns]
    if not alts:
        return None
    return f"(?iu)(?<!{WORD_CLASS})(?:{'|'.join(alts)})(?!{WORD_CLASS})"


def _replacement_literal(s: str) -> str:
    return s.replace("\\", "\\\\").replace("$", "\\$")


def wrap_hits(text: Column, terms: list[str], patterns: list[str],
              pre_tags: list[str], post_tags: list[str]) -> Column:
    """Wrap each hit in tags.  Several tag pairs are given to terms by rank
    (term i gets pair i mod n) using one pass per pair with marker characters,
    so a later pass can never match inside an earlier tag."""
    items: list[tuple[str, bool]] = [(t, False) for t in terms] + [(p, True) for p in patterns]
    n = max(1, min(len(pre_tags), len(post_tags)))
    if n == 1:
        rx = hit_regex(terms, patterns)
        if rx is None:
            return text
        rep = _replacement_literal(pre_tags[0]) + "$0" + _replacement_literal(post_tags[0])
        return F.regexp_replace(text, F.lit(rx), F.lit(rep))
    out = text
    for k in range(n):
        group = [it for i, it in enumerate(items) if i % n == k]
        rx = hit_regex([t for t, w in group if not w], [t for t, w in group if w])
        if rx is None:
            continue
        out = F.regexp_replace(out, F.lit(rx), F.lit(chr(0xE000 + 2 * k) + "$0" + chr(0xE001 + 2 * k)))
    for k in range(n):
        out = F.replace(out, F.lit(chr(0xE000 + 2 * k)), F.lit(pre_tags[k]))
        out = F.replace(out, F.lit(chr(0xE001 + 2 * k)), F.lit(post_tags[k]))
    return out


#: A phrase is its words in order; the last one may be a prefix.
Phrase = tuple[tuple[str, ...], bool]


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), lambda v: body(v)), 1)


def _with_phrases(text: Column, phrases: list[Phrase], body) -> Column:
    """``body(pieces, hits)``: the text as words and what stands between them, and the numbers of the pieces
    that are words of an occurrence of a phrase."""
    pieces = F.regexp_extract_all(text, F.lit(f"(?s){WORD_CLASS}+|(?:(?!{WORD_CLASS}).)+"), 0)

    def words(p: Column) -> Column:
        numbered = F.transform(p, lambda x, i: F.struct(F.lower(x).alias("w"), i.alias("i")))
        return F.filter(numbered, lambda x: F.regexp_like(x["w"], F.lit(f"^{WORD_CLASS}")))

    def places(w: Column, phrase: Phrase) -> Column:
        terms, prefix = phrase
        m = len(terms)

        def here(k: Column) -> Column:
            met = F.lit(True)
            for j, t in enumerate(terms):
                word = F.get(w, k + j)["w"]
                met &= word.startswith(t) if prefix and j == m - 1 else word == F.lit(t)
            return met

        starts = F.filter(F.transform(w, lambda x, k: k), lambda k: (k <= F.size(w) - m) & here(k))
        return F.flatten(F.transform(starts, lambda k: F.slice(w["i"], k + 1, m)))

    return _let(pieces, lambda p: _let(words(p), lambda w: _let(
        F.array_distinct(F.concat(*[places(w, ph) for ph in phrases])), lambda hits: body(p, hits))))


def wrap_phrases(text: Column, phrases: list[Phrase], terms: list[str], pre: str, post: str) -> Column:
    """Wrap the words of phrase occurrences, and no others; words that ``terms`` will wrap anyway are left to that."""
    if not phrases:
        return text

    def marked(pieces: Column, hits: Column) -> Column:
        return F.array_join(F.transform(pieces, lambda x, i: F.when(
            F.array_contains(hits, i) & (~F.lower(x).isin(terms) if terms else F.lit(True)), F.concat(F.lit(pre), x, F.lit(post)))
            .otherwise(x)), "")

    return _with_phrases(text, phrases, marked)


def _class_escape(chars: str) -> str:
    return "".join("\\" + c if c in "\\]^-[&" else {"\t": "\\t", "\n": "\\n"}.get(c, c) for c in chars)


def fragments(text: Column, scanner: str | None, size: int, boundary_chars: str, max_scan: int) -> Column:
    if scanner == "sentence":
        return F.filter(F.split(text, r"(?<=[.!?])\s+"), lambda s: F.length(F.trim(s)) > 0)
    if scanner == "chars":
        b = _class_escape(boundary_chars)
        rx = f"(?s).{{1,{size}}}(?:[^{b}]{{0,{max_scan}}}[{b}])?"
        return F.regexp_extract_all(text, F.lit(rx), 0)
    m = max(0, size - 2)
    rx = rf"(?s)\S(?:.{{0,{m}}}\S)?(?=\s|$)|\S{{1,{max(1, size)}}}"
    return F.regexp_extract_all(text, F.lit(rx), 0)


def highlight_column(text: Column, terms: list[str], patterns: list[str], hf: HighlightField,
                     defaults: Highlight | None = None, phrases: list[Phrase] = ()) -> Column:
    """``array<string>`` of highlighted fragments of ``text`` (null when nothing to show).

    Words of ``phrases`` are wrapped where the whole phrase stands in the fragment."""
    d = defaults or Highlight()
    pre = list(hf.pre_tags or d.pre_tags or DEFAULT_PRE_TAGS)
    post = list(hf.post_tags or d.post_tags or DEFAULT_POST_TAGS)
    size = hf.fragment_size or d.fragment_size or DEFAULT_FRAGMENT_SIZE
    nfrag = hf.number_of_fragments if hf.number_of_fragments is not None else (
        d.number_of_fragments if d.number_of_fragments is not None else DEFAULT_NUMBER_OF_FRAGMENTS)
    order = hf.order or d.order or "none"
    no_match = hf.no_match_size or 0
    text = text.cast("string")
    if no_match > 0:
        fallback = F.when(text.isNotNull(), F.array(F.substring(text, 1, no_match)))
    else:
        fallback = F.lit(None).cast("array<string>")
    rx, phrases = hit_regex(terms, patterns), list(phrases)
    if rx is None and not phrases:
        return fallback
    if nfrag == 0:
        frags = F.array(text)
    else:
        frags = fragments(text, hf.boundary_scanner, size,
                          hf.boundary_chars or DEFAULT_BOUNDARY_CHARS,
                          hf.boundary_max_scan or DEFAULT_BOUNDARY_MAX_SCAN)

    def n_hits(f: Column) -> Column:
        found = F.lit(0) if rx is None else F.size(F.regexp_extract_all(f, F.lit(rx), 0))
        return found + _with_phrases(f, phrases, lambda p, hits: F.size(hits)) if phrases else found

    kept = F.filter(frags, lambda f: F.regexp_like(f, F.lit(rx)) if not phrases else n_hits(f) > 0)
    if order == "score" and nfrag != 0:
        ranked = F.transform(kept, lambda f, i: F.struct((-n_hits(f)).alias("k"), i.alias("i"), f.alias("f")))
        kept = F.transform(F.array_sort(ranked), lambda s: s.getField("f"))
    if nfrag:
        kept = F.slice(kept, 1, nfrag)
    wrapped = F.transform(kept, lambda f: wrap_hits(wrap_phrases(f, phrases, terms, pre[0], post[0]), terms, patterns, pre, post))
    return F.when(F.size(kept) > 0, wrapped).otherwise(fallback)


# ---- response helpers (getHighlight / getHighlightFirst / getHighlightSentence) ----

def get_highlight(highlight: Column, name: str) -> Column:
    """All fragments of one field, null if none."""
    return F.try_element_at(highlight, F.lit(name))


def get_highlight_first(highlight: Column, name: str) -> Column:
    return F.try_element_at(get_highlight(highlight, name), F.lit(1))


def highlight_sentence(fragment: Column, tag: str = SENTENCE_TAG) -> Column:
    """The first sentence (split on '.' plus following blanks) holding ``tag``,
    else the fragment itself; null stays null."""
    parts = F.filter(F.split(fragment, r"\.\s*"),
                     lambda s: (F.length(F.trim(s)) > 0) & F.contains(s, F.lit(tag)))
    return F.when(fragment.isNull() | (fragment == ""), F.lit(None).cast("string")).otherwise(
        F.coalesce(F.try_element_at(parts, F.lit(1)), fragment))


def get_highlight_sentence(highlight: Column, name: str, tag: str = SENTENCE_TAG) -> Column:
    return highlight_sentence(get_highlight_first(highlight, name), tag)
