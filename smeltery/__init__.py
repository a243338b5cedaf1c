"""Medallion analytics on Spark: sales demand and machine sensor data."""

from smeltery.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
