"""Operators of a training-data pipeline: token files, sharding, packing, toxicity, HTML extraction,
secret scans, language identification, exact and near deduplication, decontamination."""
