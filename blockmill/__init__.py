"""Weighted corpus mixing and fixed-length token packing on Spark DataFrames."""

from blockmill.config import PackSettings, SourceSpec, TokenProfile

__all__ = ["PackSettings", "SourceSpec", "TokenProfile"]
