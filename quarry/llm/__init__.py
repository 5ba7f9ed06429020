"""Operators for building training data from web text.

One module per operator; each works on DataFrames and has its own general
interface.  ``queries.py`` holds the thin registered queries and their DuckDB
statements.  Nothing else in the library imports this subpackage."""
