"""Operators for training-data pipelines: matching by nearest time and work on text. Optional; the rest never imports it."""
