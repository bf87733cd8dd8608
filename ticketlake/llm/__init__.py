"""Operators for text, page and vector collections at training-data scale.

Nothing else in the library imports this subpackage; it imports general helpers of the library only.
"""
