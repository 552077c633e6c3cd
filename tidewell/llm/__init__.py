"""Operators for preparing language-model training text, one module each.

Every operator takes a DataFrame plus column names and returns a DataFrame; the
registered queries (``tidewell.llm.queries``) are thin callers with production
parameters.  Nothing outside this subpackage imports it.
"""
