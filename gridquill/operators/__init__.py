"""Operators over tables found in documents: extraction, search, ranking, hints, prompts, execution, packaging."""
