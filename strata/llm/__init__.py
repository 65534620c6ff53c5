"""Training-data operators: joins, search, filters, classifiers and writers over text tables.

Nothing else in the library imports this package. Each module holds one
operator with a general interface; ``queries.py`` binds the operators to the
driver tables.
"""
