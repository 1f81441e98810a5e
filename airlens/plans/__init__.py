"""Composite plans: ingest, analyses, presentation tables, the batch job and
the registered queries over the driver's tables."""
