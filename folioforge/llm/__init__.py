"""Operators for preparing training corpora.

Nothing else in the library imports this subpackage; ``queries`` lists what
``__spark_entry__`` registers.
"""
