"""pubstrata: Spark-native analytics over scientific publications.

Operators are plain functions from DataFrames to DataFrames:

* ``pubstrata.sources``   - table scans, publication views, sinks
* ``pubstrata.functions`` - column expressions (vectors, statistics, text)
* ``pubstrata.operators`` - embedding, neighbours, density clustering,
  periphery attachment, clustering-quality and topic metrics, annotation jobs
* ``pubstrata.plans``     - stage configuration and stage tables (reuse/resume)
* ``pubstrata.streaming`` - incremental embedding with Structured Streaming
"""

from pubstrata.columns import PubCols

__all__ = ["PubCols"]
