"""Spatial disparity analytics on Spark DataFrames."""

from evenground.plans.build import Landing, build_reference
from evenground.plans.score import DisparityResult, Upload, score
from evenground.sources.reference import ReferenceTables
from evenground.spec import CustomColumns, DisparitySpec, Filter

__all__ = [
    "CustomColumns", "DisparityResult", "DisparitySpec", "Filter", "Landing", "ReferenceTables",
    "Upload", "build_reference", "score",
]
