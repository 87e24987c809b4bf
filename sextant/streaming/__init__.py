"""Applying fitted tables to streams.

The source pipeline is batch only (no event time, watermark or state). What
carries over to a stream is the *apply* half of every fit/apply operator:
fitted statistics (modes, medians, encodings, bin edges, group statistics)
are plain tables, so a stream-static left join applies them to arriving rows
with exactly the batch semantics (a missing key takes the default)."""

from .apply import apply_lookups, scores_to_predictions  # noqa: F401
