"""Training-data operators: filters, scoring, de-duplication, search, mixing and encoding.

Nothing outside this folder imports it.  ``queries.py`` holds the registered
queries and their SQL.
"""
