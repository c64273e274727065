"""Operators for preparing training corpora: license scans, deduplication, mixing, sharding, scoring, packing.

Nothing else in the library imports this subpackage; ``queries.QUERIES`` and
``queries.ORACLE`` list what ``__spark_entry__.py`` adds to the registry.
"""
