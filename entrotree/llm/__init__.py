"""Operators of a training-data pipeline (decontamination, secrets, quality, near duplicates, ...).

Nothing outside this subpackage imports it.
"""
