"""Operators for preparing language-model training data.

One module per operator; ``queries`` registers one query per operator with
production parameters over the whole tables. Nothing outside this package
imports it.
"""
