"""Operators for training text: quality, toxicity, decontamination, scoring, secrets, token files, duplicates, packing."""
