"""Business transformations assembled from the operators."""
