"""Operators for building language-model training data.

Nothing else in the package imports this subpackage; deleting it leaves the
rest of the library whole.
"""
