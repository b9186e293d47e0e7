"""Operators for large training-data pipelines.

One module per operator. Nothing else in the library imports this
subpackage; ``loglens.llm.queries`` registers its queries.
"""
