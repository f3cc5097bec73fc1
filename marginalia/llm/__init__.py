"""Operators for preparing language-model training data at corpus scale.

Nothing else in the library imports this package; it may use the general
helpers of the rest.
"""
