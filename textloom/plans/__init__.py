from . import edits, pages, queries, search  # noqa: F401  the modules add their queries to those of queries
