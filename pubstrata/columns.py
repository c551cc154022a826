"""Late-bound column names for the publication tables.

Every operator takes a ``PubCols`` so callers can point the metrics at tables
whose columns are named differently, the way keyword column names work in the
original tool.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class PubCols:
    # clusters table
    doc: str = "id"
    topic: str = "topic"
    is_core: str = "is_core"
    probability: str = "probability"
    # docs table
    eid: str = "eid"
    title: str = "title"
    abstract: str = "abstract"
    source: str = "source"
    doctype: str = "doctype"
    year: str = "year"
    cited: str = "cited"
    sjr: str = "sjr"
    # authorship bridge
    bridge_doc: str = "doc_id"
    auth: str = "auth_id"
    aff: str = "aff_id"
    seqn: str = "auth_seqn"
    # affiliations
    aff_id: str = "id"
    country: str = "Country"


DEFAULT_COLS = PubCols()


def require_columns(df: DataFrame, needed: list[str], what: str = "DataFrame") -> None:
    """Raise ``ValueError`` naming the columns that ``df`` lacks."""
    missing = sorted(set(needed) - set(df.columns))
    if missing:
        raise ValueError(f"{what} is missing required columns: {missing}")
