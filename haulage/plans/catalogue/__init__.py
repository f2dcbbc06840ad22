"""Named queries over the supplied tables, each with the SQL that must give the same rows."""

from haulage.plans.catalogue import applying, checking, eventing, exporting, filing, loading, purging, reporting, streams, timing  # noqa: F401
from haulage.plans.catalogue.base import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
