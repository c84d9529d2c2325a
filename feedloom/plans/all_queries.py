"""Importing this module registers every query."""

from . import q_functions, q_history, q_keyed, q_samples, q_scans, q_stream, q_training  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
