"""Operators of a large-scale training-data pipeline.

Each module holds one operator with a general interface; ``registry`` holds the
thin queries over the ``documents``, ``pages`` and ``benchmark`` tables.
Nothing outside this subpackage imports it.
"""
