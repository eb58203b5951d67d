"""Table preparation, boosted-tree training and batch scoring as Spark jobs."""

__version__ = "0.1.0"
