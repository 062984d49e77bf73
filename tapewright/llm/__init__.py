"""Operators for preparing training text: scoring, deduplication, decontamination, mixing, output.

Nothing else in the library imports this subpackage.
"""
