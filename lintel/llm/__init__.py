"""Operators of training-data pipelines over document tables (doc_id, text, ...)."""
