"""Training-data operators: text scoring, near-duplicate search, packing, chat views and sharding.

Nothing outside this subpackage imports it.  Each operator takes DataFrames and column names and
returns a DataFrame; ``queries`` applies them to the given tables.
"""
