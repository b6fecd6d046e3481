"""Operators for preparing training text at scale.

Nothing else in the library imports this subpackage.  Every operator takes and
returns DataFrames; ``queries.py`` binds them to the driver tables.
"""
