"""Training-data operators: packing, fingerprints, language id, licence scans,
suffix dedup, token files, mixing, quality rules, near-dedup and URL filters.

Nothing outside this package imports it.  ``queries.py`` holds the registered
``opN_*`` queries, the other modules the operators themselves.
"""
