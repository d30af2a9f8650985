"""Image-corpus curation as ordinary Spark DataFrame jobs."""
