"""Compositions of the operators: the full warehouse build, incremental runs,
and stand-ins for gaps in partial test extracts."""

from sparkmarts.plans.warehouse import Warehouse

__all__ = ["Warehouse"]
