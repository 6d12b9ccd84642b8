"""Operators of a training-data pipeline over document tables.

Nothing else in the library imports this package; its queries are registered
in ``wharf.llm.queries``.
"""
