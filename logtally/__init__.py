"""Audit-log analytics as functions from DataFrames to DataFrames.

``sources``    archive, dimension files, run store, published output
``functions``  column expressions: defensive casts, payload paths, clocks
``operators``  row-level views, dimensions, metrics, drill-down, ordered helpers
``plans``      whole jobs built from them: ingest, series, checks, recipes, snapshot
"""
