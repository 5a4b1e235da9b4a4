"""Operators of a training-data pipeline over text: quality, privacy, duplicates, packing, extraction.

Nothing outside this subpackage imports it.  Every operator takes DataFrames and
returns DataFrames; ``queries`` holds the registered queries.
"""
