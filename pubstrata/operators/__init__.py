"""Operators: embedding, neighbours, density clustering, periphery, quality and topic metrics, annotation."""
