"""Operators of a training-data pipeline.

Nothing outside this package imports it; ``__spark_entry__.py`` registers its
queries when the package is present.
"""
