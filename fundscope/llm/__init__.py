"""Operators for preparing language-model training data.

Nothing outside this subpackage imports it.  Every operator takes DataFrames and returns DataFrames; the
registered queries and their SQL are in ``fundscope.llm.queries``.
"""
