"""Operators of a training-data pipeline: documents in, decisions, scores, spans and shards out."""
