"""Incremental table export and load analytics on PySpark."""

from haulage.session import build_session, shared_folder

__all__ = ["build_session", "shared_folder"]
