"""Operators for preparing text corpora: tokens, duplicates, language models, neighbours, mixing, quality, licenses."""
