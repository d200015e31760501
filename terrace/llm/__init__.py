"""Operators for preparing large text and vector corpora (deduplication, filtering,
tokenising, mixing, nearest neighbours, page extraction).

Nothing else in the library imports this subpackage.  ``terrace.llm.queries``
registers one query per operator.
"""
