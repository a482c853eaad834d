"""Operators for training-data corpora: near copies, packing, extraction, quality and others.

Nothing outside this folder imports it.
"""
