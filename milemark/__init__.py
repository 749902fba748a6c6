"""Usage-based motor-insurance analytics as plain ``DataFrame -> DataFrame`` functions."""
