"""Operators for training-data pipelines: dedup, scans, packing, token files, formatting, PII, quality,
decontamination, sharding, media, mixing, manifests and vector codes. Nothing else in the library imports this
subpackage."""
