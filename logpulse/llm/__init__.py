"""Operators over text corpora: tokens, language, toxicity, secrets, duplicates, pages."""
