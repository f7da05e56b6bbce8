"""Entity resolution, record fusion and training-data operators as lazy Spark plans."""
