"""Quarterly peer benchmarking on Spark: ingest, clean, load, compare, publish."""

from peerline.session import build_session
from peerline.specs import SPECS, Measure, TableSpec

__all__ = ["SPECS", "Measure", "TableSpec", "build_session"]
