"""harborlight: batch and streaming data jobs on PySpark."""
