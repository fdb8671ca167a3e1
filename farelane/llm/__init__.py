"""Training-data operators: one module per operator, each built by its own named method.

Nothing else in the library imports this subpackage.  ``registry`` holds the
queries and their reference SQL.
"""
