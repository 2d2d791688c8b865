"""Operators for preparing language-model training data.

Nothing else in ``motionframe`` imports this subpackage.  ``registry`` holds the
queries and the SQL that checks them.
"""
