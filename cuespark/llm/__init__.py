"""Operators of a training-data pipeline: chat collapse, near-dedup,
decontamination, WARC derivatives, line quality, secret scans, line dedup,
URL filters, source mixing, token-ID files, importance resampling,
cross-tokenizer alignment and document fingerprints.

Nothing outside this subpackage imports it; ``queries.QUERIES`` and
``oracle.ORACLE`` hold the registered queries and their SQL statements.
"""
