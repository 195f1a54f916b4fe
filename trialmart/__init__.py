"""Trial-registry analytics expressed as Spark DataFrame work."""
