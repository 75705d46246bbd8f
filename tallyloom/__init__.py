"""Record conformance and reconciliation on Spark DataFrames.

Text extracts of the same business entities from several providers are
cleaned, mapped to one canonical typed schema and reconciled into versioned
core tables; ordered rules enrich the core, and new or changed records are cut
into batches of rendered payloads for a remote system whose identifiers are
written back.
"""
