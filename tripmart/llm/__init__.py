"""Operators for preparing language-model training data.

Each module holds one operator with its own general interface; ``queries`` binds them to the
driver's tables. ``common`` has the shared scratch-table and Arrow helpers and ``components``
the distributed union-find. Nothing outside this package imports it.
"""
