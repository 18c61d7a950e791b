"""Analytics over captured web pages, expressed as Spark DataFrame jobs."""

from pageloom.session import checkpoint_dir, get_spark

__all__ = ["checkpoint_dir", "get_spark"]
