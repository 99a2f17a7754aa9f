"""Operators of a training-data pipeline over document, page and vector tables.

Nothing outside this subpackage imports it.  Each module holds one operator
with its general interface; ``queries`` binds them to the given tables."""
