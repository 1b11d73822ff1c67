"""lahar: hazard-exposure analytics as lazy Spark plans."""
