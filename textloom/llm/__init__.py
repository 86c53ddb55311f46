"""Operators for large training-data pipelines.

Nothing else in the package imports this folder. ``queries.QUERIES`` and
``oracles.ORACLES`` hold one query per operator.
"""
