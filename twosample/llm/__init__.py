"""Operators of a training-data pipeline: deduplication, decontamination,
quality and language models, license scans, mixing and sharding.

Nothing else in the library imports this subpackage."""
