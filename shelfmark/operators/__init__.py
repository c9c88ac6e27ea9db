"""DataFrame operators: jobs, filters, debounce, documents, index tables, harvest state, postings."""
