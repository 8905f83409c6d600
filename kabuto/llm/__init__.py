"""Operators for large-scale training-data pipelines.

Nothing else in the library imports this subpackage. Each module holds one operator with its own
general interface; ``queries`` binds them to the test tables, ``oracle`` holds the SQL of those
that SQL can express.
"""
