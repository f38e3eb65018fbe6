"""Training-data operators: sharding, extraction, tokenising, search, packing, near
duplicates, quality, personal data and language, each as Spark jobs.

Nothing outside this subpackage (but ``__spark_entry__.py`` and ``corpus_pipeline.py``)
imports it.
"""
