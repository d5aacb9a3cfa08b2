"""Operators for preparing language-model training data.

Each module holds one operator as ``DataFrame -> DataFrame`` functions; the
queries that apply them to the driver tables are in ``queries``. Nothing else
in the library imports this subpackage.
"""
