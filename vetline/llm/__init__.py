"""Operators for preparing language-model training data.

Nothing outside this package (and ``corpus_pipeline.py``, its pipeline)
imports it. ``queries.py`` here registers the package's queries.
"""
