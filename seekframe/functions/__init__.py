"""Column builders: analysers, BM25 arithmetic, highlighting."""
