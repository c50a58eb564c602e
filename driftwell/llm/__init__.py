"""Training-data operators: packing, scoring, mixing, filtering, search, dedup.

Nothing outside this subpackage imports it.  ``registry`` holds the queries.
"""
