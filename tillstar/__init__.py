"""tillstar: a retail sales warehouse on Spark.

Multi-format ingest with keep-last de-duplication, conformed dimensions and sales facts with
upsert semantics and key checks, and daily revenue marts, all as DataFrame plans.
"""
