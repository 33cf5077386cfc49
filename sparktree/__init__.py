"""sparktree: a Spark-first engine for point-cloud, terrain and tree-inventory analytics."""

__version__ = "0.1.0"
