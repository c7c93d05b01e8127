"""Imports every query module so that the registry is complete."""

from __future__ import annotations

from . import q_forecast_triage, q_graph_model, q_io, q_layers, q_reports  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
