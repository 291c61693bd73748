"""DataFrame operators: spans, tags, relations, evaluation, comparison, curation."""
