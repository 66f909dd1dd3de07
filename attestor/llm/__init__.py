"""Training-data operators: deduplication, tokenising, packing, privacy, quality, chat and web archives.

Nothing outside this subpackage imports it; it can be removed as a whole.
"""
