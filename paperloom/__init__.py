"""Paper metadata and embedding tables maintained as Spark jobs."""

from paperloom.schema import ModelSpec, PAPER_COLUMNS, PAPER_SCHEMA
from paperloom.session import build_session, cut_lineage, shared_dir

__all__ = [
    "ModelSpec",
    "PAPER_COLUMNS",
    "PAPER_SCHEMA",
    "build_session",
    "cut_lineage",
    "shared_dir",
]
