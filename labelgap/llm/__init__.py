"""Operators of a training-data pipeline: filtering, deduplication, tokenizing and scoring of text.

Nothing else in the library imports this package; it may import the library's
general helpers. ``registry`` lists its queries next to the SQL they must
agree with.
"""
