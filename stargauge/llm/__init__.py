"""Operators for preparing language-model training data.

Nothing outside this package imports it; the registered queries are in :mod:`stargauge.llm.queries`.
"""
