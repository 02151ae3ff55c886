"""Operators of a training-data pipeline over text tables.

Nothing else in the library imports this subpackage.  ``queries`` has one
query per operator, over the whole table it is meant for.
"""
