"""DataFrame building blocks; every one takes its column names as parameters."""
