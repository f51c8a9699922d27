"""reviewlens: review analytics, home areas, expertise and local ranking as Spark jobs."""
