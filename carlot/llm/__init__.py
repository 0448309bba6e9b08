"""Corpus operators for training data (deduplication, filtering, packing, ...).

One module per operator; ``queries`` registers one production query for each,
``oracles`` holds the SQL twins. Nothing outside this folder imports it except
the guarded hook in ``__spark_entry__``.
"""
