"""Spark jobs for record ETL, data quality and data governance on plain tables."""

from tablewarden.session import build_session, scratch_root

__all__ = ["build_session", "scratch_root"]
