"""Operators of a training-data pipeline: deduplication, language and quality models, decontamination, mixing, output.

Nothing else in the library imports this subpackage.
"""
