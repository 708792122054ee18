"""Operators for preparing training corpora: toxicity, line and document
dedup, quality rules, private data, WARC archives, sharding, mixing, packing
and embedding dedup. Nothing else in the library imports this subpackage."""
