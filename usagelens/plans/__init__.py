"""Reports, marts and training runs assembled from the operators."""
