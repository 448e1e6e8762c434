"""Training-data operators: deduplication, decontamination, sharding, token
counts, archives, personal data, BPE, quality. Nothing else in the library
imports this subpackage; it may import the library's general helpers."""
