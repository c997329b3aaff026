"""Variant-annotation analytics on Spark DataFrames."""

from varloom.params import Params
from varloom.session import build_session, configure, shared_dir

__all__ = ["Params", "build_session", "configure", "shared_dir"]
