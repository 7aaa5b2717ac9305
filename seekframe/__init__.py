"""seekframe: relevance search and document-table maintenance as Spark jobs.

An index is a DataFrame; a query compiles to native Column expressions for
*matched* and *score*; search, paging, highlighting, bulk mutation and ingest
are plain DataFrame plans that Catalyst optimises and Spark distributes.
"""

from .functions.analysis import query_terms, tokenize
from .functions.highlight import (Highlight, HighlightField, get_highlight, get_highlight_first,
                                  get_highlight_sentence, highlight_sentence)
from .operators.clauses import (Bool, Exists, FunctionScore, Match, MatchAll, MatchNone, MatchPhrase,
                                MatchPhrasePrefix, MultiMatch, Nested, Range, Raw, ScoreFunction, Term,
                                Terms, Wildcard, each, from_dict, when, when_else)
from .operators.search import SearchResult, SortKey, count, count_frame, get_by_ids, matching, search
from .sources.index import Index
from .sources.mapping import Mapping

__all__ = [
    "Bool", "Exists", "FunctionScore", "Highlight", "HighlightField", "Index", "Mapping", "Match",
    "MatchAll", "MatchNone", "MatchPhrase", "MatchPhrasePrefix", "MultiMatch", "Nested", "Range", "Raw",
    "ScoreFunction", "SearchResult", "SortKey", "Term", "Terms", "Wildcard", "count", "count_frame",
    "each", "from_dict", "get_by_ids", "get_highlight", "get_highlight_first", "get_highlight_sentence",
    "highlight_sentence", "matching", "query_terms", "search", "tokenize", "when", "when_else",
]
