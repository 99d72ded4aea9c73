"""lotledger: inventory analytics over captured pages, written for Spark.

Captured pages and JSON responses (``captures``) become typed vehicle rows, one
winning extraction layer per dealer, upserted history tables and reports.
"""
