"""Operators for large text corpora: deduplication, extraction, archives, packing, tokens, privacy, quality.

Nothing outside this subpackage imports it. ``queries.QUERIES`` and ``queries.ORACLE`` hold the
registered queries; every operator has its own module and works on any DataFrame.
"""
