"""Operators of a training-data pipeline, one module each.

Nothing outside this package imports it. ``queries`` registers one query per
operator; the other modules hold the operators with their general interface.
"""
