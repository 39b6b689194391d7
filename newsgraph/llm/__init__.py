"""Operators for preparing language-model training data at scale.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it."""
