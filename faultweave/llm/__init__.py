"""Operators that prepare text for training language models.

Nothing else in the library imports this package. Each operator is a function of a
DataFrame of documents (doc_id, text, lang, source, n_chars, and any further columns).
"""
