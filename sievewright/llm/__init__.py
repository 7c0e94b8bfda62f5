"""Operators for preparing language-model training data.

Ten operators, each in a module of its own, over tables shaped like
``documents`` (doc_id, text, lang, source, n_chars), ``pages`` and
``embeddings``.  ``queries.py`` holds the thin contract queries built on them.
Nothing outside this subpackage imports it.
"""
