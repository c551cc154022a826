from pubstrata.sources.fixtures import Publications, publications

__all__ = ["Publications", "publications"]
