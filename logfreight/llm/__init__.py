"""Operators of a training-data pipeline: tokens, language, near copies, packing, scoring."""
