"""The operators on the shared test tables: input mapping, queries and their SQL counterparts."""
