"""Operators that prepare training data: one module per operator, all as Spark jobs.

``queries`` registers one query per operator; ``corpus_pipeline.py`` at the
repository top chains five of them.  Nothing outside this package imports it.
"""
