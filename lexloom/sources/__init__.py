"""Readers and writers of corpora, vocabularies, vectors and model tables."""
