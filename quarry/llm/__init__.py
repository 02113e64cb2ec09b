"""Training-data operators: fingerprints, scans, media, packing, dedup, language, tokens."""
