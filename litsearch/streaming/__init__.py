"""Incremental extraction and the link frontier as streams."""
