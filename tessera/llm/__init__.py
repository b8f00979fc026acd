"""Training-data operators: packing, quality, WARC, byte-level BPE, fingerprints,
licence scans, near-duplicates, page extraction, token counts and repeat removal.

Nothing outside this package imports it.
"""
