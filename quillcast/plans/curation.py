"""From scores to the published manifest as one lazy plan; only small tables of readers are folded."""

from __future__ import annotations

from pyspark.sql import DataFrame

from quillcast.operators import manifest, scores, split


def score(features: DataFrame, axes: DataFrame | None, baseline: DataFrame) -> DataFrame:
    """Features with text columns to scores: axes, fallback baselines, delivery and flags."""
    cols = [f"{f}_{s}" for f in scores.AXIS_FEATURES.values() for s in ("med", "scale")]
    described = scores.with_axes(features, axes)
    return scores.junk_flags(scores.delivery(scores.hierarchical_fallback(described, baseline, cols)))


def curate(scored: DataFrame, dataset: DataFrame, registry: DataFrame, gender: DataFrame, audio_index: DataFrame | None = None, ratios: dict[str, float] = split.RATIOS) -> DataFrame:
    """The manifest with its split column."""
    rows = manifest.build(scored, dataset, registry, gender, audio_index=audio_index)
    return split.assign(rows, split.lpt_split(split.reader_hours(rows), ratios))
