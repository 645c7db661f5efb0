"""Operators for preparing large text corpora for language-model training.

Self-contained: nothing else in the package imports this subpackage.
"""
