"""Training-data operators for very large corpora.

Each module holds one operator with a general interface; :mod:`millrace.llm.queries`
registers one query for each. Nothing else in the library imports this subpackage.
"""
