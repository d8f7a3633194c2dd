"""modelwatch: data work around a binary classifier, expressed as Spark jobs."""
