"""Queries over the given tables that exercise every operator and dataset."""

from . import datasets, operators, pages  # noqa: F401
from .inputs import QUERIES, SQL  # noqa: F401
