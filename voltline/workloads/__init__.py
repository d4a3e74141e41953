"""Importing this package registers every workload."""

from . import completeness, factors, files, loads, panels, stored, units, windows  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
