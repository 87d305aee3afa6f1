"""terrace: medallion pipelines (bronze, silver, gold, cold history) as plain Spark plans."""

from terrace.layout import Layout

__all__ = ["Layout"]
