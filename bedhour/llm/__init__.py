"""Operators that prepare text collections for training language models.

Nothing else in the library imports this subpackage. Every operator takes
DataFrames and returns DataFrames; the ``opN_<name>`` queries over the test
tables are in ``queries``.
"""
