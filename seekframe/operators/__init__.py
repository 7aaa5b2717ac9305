"""DataFrame operators: clause compiler, search, postings/batch search, mutations."""
