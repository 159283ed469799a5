"""Operators for preparing language-model training corpora.

Nothing outside this subpackage imports it.  Every operator takes a DataFrame,
selects the columns it needs (so extra or clashing columns are ignored) and
returns a DataFrame.  Intermediate tables go to the shared folder named by
``spark.checkpoint.dir``.
"""
