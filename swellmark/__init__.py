"""Event-versus-price analytics written as Spark DataFrame operators."""
