"""Operators for large-scale training-data pipelines. Nothing else in newsflow imports this subpackage."""
