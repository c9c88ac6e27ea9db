"""The operators run over the given test tables: adapters, queries and their SQL counterparts."""
