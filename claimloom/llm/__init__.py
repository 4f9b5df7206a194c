"""Operators of a training-data pipeline over the tables of documents and embeddings.

Nothing outside this subpackage imports it; ``corpus_pipeline.py`` at the repository top chains
five of the operators, ``queries`` registers one query per operator.
"""
