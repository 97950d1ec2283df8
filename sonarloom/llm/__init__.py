"""Operators for training-data pipelines over large document tables.

Nothing outside this subpackage imports it; ``catalog`` lists its queries."""
