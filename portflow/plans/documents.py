"""Export every mart as a JSON result document.

Each document is one JSON object ``{"data": [rows...]}`` written as a single
text file; NULLs are written out, decimals as numbers, dates as ISO text.
Mart outputs are bounded (months x ports x lanes), so folding one into a
single document row is safe; fact rows are never exported this way.
"""

from __future__ import annotations

from portflow.plans import marts
from portflow.plans.registry import _MARTS
from portflow.session import subdir
from portflow.sinks import write_document
from portflow.sources.testdata import Model

NESTED = ["heatmap_matrix", "series_map", "combos_default"]


def export_documents(m: Model, root: str, names: list[str] | None = None) -> list[str]:
    """Write ``root/<mart>/part-*.txt`` for each mart; returns the names."""
    names = names or (_MARTS + NESTED)
    for name in names:
        write_document(getattr(marts, name)(m), subdir(root, name))
    return names
