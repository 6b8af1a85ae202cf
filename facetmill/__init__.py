"""facetmill: retail event analytics on PySpark DataFrames.

Sub-packages
------------
functions   column expressions (prices, keys, dates, URLs, defaults)
sources     readers and writers with declared schemas
operators   DataFrame -> DataFrame building blocks (scans, joins, upserts, checks)
plans       named tables of the warehouse, composed from the operators
streaming   Structured Streaming forms of ingest, de-duplication and late data
"""
