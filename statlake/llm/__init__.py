"""Operators of a training-data pipeline: search, secret scans, mixing,
archives, deduplication, scoring, extraction and decontamination.

Nothing else in ``statlake`` imports this package.  Each module holds one
operator; ``queries`` registers one query per operator.
"""
