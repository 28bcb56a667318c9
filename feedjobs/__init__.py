"""feedjobs: PySpark jobs that turn landed posts into a deduplicated, ranked feed."""
