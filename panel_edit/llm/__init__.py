"""Operators for preparing language-model training data at corpus scale.

Nothing outside this subpackage, its tests and ``corpus_pipeline.py`` imports it.
"""
