"""Training-data operators: mixing, deduplication, search, scoring, packing, token output.

Nothing outside this subpackage imports it. Every operator is a function over
DataFrames; :mod:`paylens.llm.queries` registers one query per operator.
"""
