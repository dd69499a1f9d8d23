"""Option-quote analytics expressed as Spark DataFrame plans."""
