"""Operators of a training-data pipeline (language models, dedup, packing, ...).

Nothing else in the library imports this subpackage; it can be deleted without
touching the rest.  Queries over the driver's tables live in ``queries``.
"""
