"""Operators of a training-data pipeline.

Each module holds one operator with its own general interface; ``queries``
holds the thin ``opN_<name>`` queries over the driver tables and their SQL.
Nothing outside this subpackage imports it.
"""
