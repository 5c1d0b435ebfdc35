"""Operators of a training-data pipeline over whole tables of documents, pages and conversations."""
