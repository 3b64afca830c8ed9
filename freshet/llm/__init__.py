"""Operators for training-data pipelines: sharding, packing, quality, chat, extraction, search and archives.

Each module holds one operator with a general interface. ``queries`` applies every
operator to its whole table; the repository's ``corpus_pipeline`` chains five of them.

Rules shared by all: a null text counts as empty unless a docstring says otherwise,
extra columns of the input are ignored or carried along whatever their names, repeated
rows are rows of their own, and empty tables give empty results.
"""
