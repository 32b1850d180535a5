"""Sources: delimited and parquet staging, load-error reports, documents, market charts."""

from starloom.sources.delimited import load_errors, render_path, stage_delimited
from starloom.sources.documents import append_documents, flatten_market_chart, read_documents
from starloom.sources.parquet import stage_parquet

__all__ = [
    "append_documents", "flatten_market_chart", "load_errors", "read_documents", "render_path",
    "stage_delimited", "stage_parquet",
]
