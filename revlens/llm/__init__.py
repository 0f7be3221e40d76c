"""Operators for large training-data pipelines (top-k search, language-model
scoring, quality, near-duplicates, token counts, conversations, personal data,
byte-pair encoding, decontamination, toxicity). Nothing else in the library
imports this subpackage."""
