"""Training-data operators: packing, scanning, sharding, fingerprints, deduplication, quality.

Every operator takes a documents table (``doc_id``, ``text``; other columns are
ignored or carried, never mixed with internal ones) and returns a DataFrame.
Nothing outside this subpackage imports it. ``queries.py`` registers the
contract queries, ``/corpus_pipeline.py`` chains five operators.
"""
