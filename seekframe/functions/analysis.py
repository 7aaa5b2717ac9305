"""Analysers: turn a string column into an array of terms.

Every analyser has two faces that must agree term for term:

* ``column(col)``  - a native Spark expression (JVM side, codegen) used on the
  index rows, so tokenising a 100 TB corpus never leaves the executors;
* ``terms(text)``  - the same rule in Python, used only on the *query* text,
  which is a few words held by the driver.

Analysers are looked up by name in a registry; index settings may add custom
ones (n-gram, edge n-gram, stop words) through :func:`analyzer_from_settings`.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must stay exactly as written: they define which terms exist).
# Word characters of the standard analyser: Unicode letters, digits, marks, '_'.
WORD_CLASS = r"[\p{L}\p{N}\p{M}_]"
STANDARD_TOKEN = WORD_CLASS + "+"
SIMPLE_TOKEN = r"\p{L}+"
WHITESPACE_TOKEN = r"\S+"
# English stop words removed by the "stop" and "english" analysers.
ENGLISH_STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in",
    "into", "is", "it", "no", "not", "of", "on", "or", "such", "that", "the",
    "their", "then", "there", "these", "they", "this", "to", "was", "will",
    "with",
)
# ---------------------------------------------------------------------------


def _regex_column(pattern: str, lower: bool) -> Callable[[Column], Column]:
    def build(col: Column) -> Column:
        src = F.lower(col) if lower else col
        return F.regexp_extract_all(src, F.lit(pattern), 0)

    return build


def _regex_terms(pattern: str, lower: bool) -> Callable[[str], list[str]]:
    compiled = regex.compile(pattern)

    def run(text: str) -> list[str]:
        if text is None:
            return []
        return compiled.findall(text.lower() if lower else text)

    return run


@dataclass(frozen=True)
class Analyzer:
    """A named tokenising rule with a Spark face and a Python face."""

    name: str
    column: Callable[[Column], Column]
    terms: Callable[[str], list[str]]
    stop_words: tuple[str, ...] = field(default=())

    def __post_init__(self):
        if self.stop_words:
            stops = self.stop_words
            col_fn, py_fn = self.column, self.terms
            object.__setattr__(
                self,
                "column",
                lambda c: F.filter(col_fn(c), lambda t: ~t.isin(*stops)),
            )
            object.__setattr__(
                self, "terms", lambda s: [t for t in py_fn(s) if t not in stops]
            )
            object.__setattr__(self, "stop_words", ())


def _keyword_column(col: Column) -> Column:
    return F.when(col.isNotNull(), F.array(col.cast("string")))


def _keyword_terms(text) -> list[str]:
    return [] if text is None else [str(text)]


def ngram_column(min_gram: int, max_gram: int, lower: bool = True, edge: bool = False):
    """All substrings of length ``min_gram..max_gram`` (position-major order).

    ``edge=True`` keeps only prefixes. Values shorter than ``min_gram`` give an
    empty array. Pure higher-order functions, no Python on the row path.
    """

    def build(col: Column) -> Column:
        s = F.lower(col) if lower else col
        n = F.length(s)
        sizes = F.sequence(F.lit(min_gram), F.lit(max_gram))
        if edge:
            grams = F.transform(
                F.filter(sizes, lambda k: k <= n), lambda k: F.substring(s, 1, k)
            )
        else:
            starts = F.when(n >= min_gram, F.sequence(F.lit(1), n - min_gram + 1)).otherwise(
                F.array().cast("array<int>")
            )
            grams = F.flatten(
                F.transform(
                    starts,
                    lambda i: F.transform(
                        F.filter(sizes, lambda k: i + k - 1 <= n),
                        lambda k: F.substring(s, i, k),
                    ),
                )
            )
        return F.when(col.isNotNull(), grams)

    return build


def ngram_terms(min_gram: int, max_gram: int, lower: bool = True, edge: bool = False):
    def run(text: str) -> list[str]:
        if text is None:
            return []
        s = text.lower() if lower else text
        if edge:
            return [s[:k] for k in range(min_gram, max_gram + 1) if k <= len(s)]
        return [
            s[i : i + k]
            for i in range(0, len(s) - min_gram + 1)
            for k in range(min_gram, max_gram + 1)
            if i + k <= len(s)
        ]

    return run


_BUILTIN: dict[str, Analyzer] = {
    "standard": Analyzer(
        "standard", _regex_column(STANDARD_TOKEN, True), _regex_terms(STANDARD_TOKEN, True)
    ),
    "simple": Analyzer(
        "simple", _regex_column(SIMPLE_TOKEN, True), _regex_terms(SIMPLE_TOKEN, True)
    ),
    "whitespace": Analyzer(
        "whitespace",
        _regex_column(WHITESPACE_TOKEN, False),
        _regex_terms(WHITESPACE_TOKEN, False),
    ),
    "keyword": Analyzer("keyword", _keyword_column, _keyword_terms),
    "stop": Analyzer(
        "stop",
        _regex_column(STANDARD_TOKEN, True),
        _regex_terms(STANDARD_TOKEN, True),
        ENGLISH_STOP_WORDS,
    ),
    # No stemmer: "english" is the standard rule minus English stop words.
    "english": Analyzer(
        "english",
        _regex_column(STANDARD_TOKEN, True),
        _regex_terms(STANDARD_TOKEN, True),
        ENGLISH_STOP_WORDS,
    ),
}


class AnalyzerRegistry:
    """Built-in analysers plus the custom ones declared in index settings."""

    def __init__(self, custom: dict[str, Analyzer] | None = None):
        self._items = dict(_BUILTIN)
        self._items.update(custom or {})

    def get(self, name: str | None) -> Analyzer:
        key = name or "standard"
        if key not in self._items:
            raise KeyError(f"unknown analyzer: {key}")
        return self._items[key]

    def register(self, analyzer: Analyzer) -> None:
        self._items[analyzer.name] = analyzer

    def names(self) -> list[str]:
        return sorted(self._items)


DEFAULT_ANALYZERS = AnalyzerRegistry()


def tokenize(col: Column | str, analyzer: str | None = None) -> Column:
    """Spark expression: the terms of ``col`` under ``analyzer`` (default standard)."""
    c = F.col(col) if isinstance(col, str) else col
    return DEFAULT_ANALYZERS.get(analyzer).column(c)


def query_terms(text: str, analyzer: str | None = None, registry: AnalyzerRegistry | None = None) -> list[str]:
    """Terms of a query string, distinct, in first-seen order (driver side, tiny)."""
    reg = registry or DEFAULT_ANALYZERS
    seen: dict[str, None] = {}
    for t in reg.get(analyzer).terms(text):
        seen.setdefault(t, None)
    return list(seen)


def analyzer_from_settings(name: str, spec: dict, tokenizers: dict | None = None) -> Analyzer:
    """Build a custom analyser from an ``analysis`` settings entry.

    Supported tokenizers: ``standard``, ``whitespace``, ``keyword``, ``ngram``,
    ``edge_ngram`` (with ``min_gram``/``max_gram``); filters: ``lowercase``,
    ``stop``.
    """
    tokenizers = tokenizers or {}
    tok_name = spec.get("tokenizer", "standard")
    tok = tokenizers.get(tok_name, {"type": tok_name})
    kind = tok.get("type", tok_name)
    filters = spec.get("filter", [])
    lower = "lowercase" in filters or kind == "standard"
    stops = ENGLISH_STOP_WORDS if "stop" in filters else ()
    if kind in ("ngram", "edge_ngram"):
        lo, hi = int(tok.get("min_gram", 1)), int(tok.get("max_gram", 2))
        edge = kind == "edge_ngram"
        return Analyzer(name, ngram_column(lo, hi, lower, edge), ngram_terms(lo, hi, lower, edge), stops)
    if kind == "whitespace":
        pat = WHITESPACE_TOKEN
    elif kind == "keyword":
        return Analyzer(name, _keyword_column, _keyword_terms, stops)
    else:
        pat = STANDARD_TOKEN
    return Analyzer(name, _regex_column(pat, lower), _regex_terms(pat, lower), stops)
