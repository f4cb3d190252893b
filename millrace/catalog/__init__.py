"""Driver queries of the library's own operators, each with the SQL that repeats it."""

from millrace.catalog import conversations, documents, evaluation, selection, stream

MODULES = (conversations, documents, selection, evaluation, stream)
QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
ORACLES = {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
