"""Table and stream operators for governed, versioned, provenance-carrying data on Spark."""
