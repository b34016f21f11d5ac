"""Operators on training text: personal data, secrets, tokens, language model, pages, quality, overlap, toxicity."""
