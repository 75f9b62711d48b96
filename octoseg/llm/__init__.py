"""Operators for training-data pipelines: pairs, neighbours, near-duplicates, quantiles, clusters, texts.

Nothing outside this package imports it; `__spark_entry__` adds its queries if it is there.
"""
