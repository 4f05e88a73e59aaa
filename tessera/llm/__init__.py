"""Training-data operators: encoding, language, packing, search, toxicity, id files,
quality rules, substring and SimHash deduplication, quality scores.

Nothing else in the library imports this subpackage.
"""
