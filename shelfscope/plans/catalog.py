"""Imports every query module so the registry is complete."""

from . import (q_describe, q_features, q_inference, q_ingest, q_kpi, q_mix, q_quality,  # noqa: F401
               q_models, q_runs, q_segment, q_sinks, q_trend, q_whatif)
from .registry import REGISTRY, oracle, run_query  # noqa: F401
