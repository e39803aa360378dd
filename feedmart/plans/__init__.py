"""Pipelines: full load (E1) and delta load (E2), landing -> raw -> core -> mart."""

from feedmart.plans.load import build_mart, delta_load, full_load, load_core, load_raw

__all__ = ["build_mart", "delta_load", "full_load", "load_core", "load_raw"]
