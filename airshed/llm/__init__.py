"""Operators for large-scale training-data pipelines.

Nothing outside this folder imports it.  Each module is one operator with its own general
interface; ``queries.py`` registers one query per operator over the driver's tables.
"""
