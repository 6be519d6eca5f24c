"""Operators and the pipeline for training data of language models."""
