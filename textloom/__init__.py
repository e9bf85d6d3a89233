"""Document-corpus analytics expressed as Spark DataFrame plans."""
