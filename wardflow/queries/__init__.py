"""All registered queries."""

from importlib import import_module

MODULES = ["views", "reports", "ingest", "joins", "aggregates", "reshape", "windows", "missing", "dates", "sets", "text", "chains", "files", "streams", "basics"]

for _name in MODULES:
    import_module(f"wardflow.queries.{_name}")

from wardflow.queries.registry import ORACLE, QUERIES  # noqa: E402

__all__ = ["ORACLE", "QUERIES"]
