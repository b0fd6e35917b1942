"""Operators for preparing training data, their queries and their SQL twins.

Nothing else in the library imports this subpackage; ``__spark_entry__`` adds its queries when
it is there. ``registry`` holds the queries.
"""
