"""The registered queries of this subpackage and their SQL, gathered from its modules."""

from __future__ import annotations

import importlib

#: Modules with ``QUERIES`` (name to function of session and folder) and ``SQL`` (name to text).
MODULES = ("language", "chat", "vptree", "repeats", "mixing", "toxicity", "quality", "simhash", "pieces", "hnsw",
           "codes", "sketches", "infill")

QUERIES = {}
SQL = {}
for _name in MODULES:
    _module = importlib.import_module(f"weekloom.llm.{_name}")
    QUERIES.update(_module.QUERIES)
    SQL.update(_module.SQL)
