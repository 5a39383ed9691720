"""Incremental conversion of document pages to analysed markdown, on Spark."""
