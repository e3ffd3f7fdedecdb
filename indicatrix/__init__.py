"""Country and organisation indicators from differently shaped tables, as lazy Spark plans."""

from .operators.registry import Registry, load_registry
from .plans.collect import KINDS, Kind, dataset, datasets, indicators

__all__ = ["KINDS", "Kind", "Registry", "dataset", "datasets", "indicators", "load_registry"]
