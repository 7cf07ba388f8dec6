from bandwatch.catalog import model, scans, scoring, series, sinks, streams  # noqa: F401
from bandwatch.catalog.base import REGISTRY

__all__ = ["REGISTRY"]
