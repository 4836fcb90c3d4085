"""Data products: pipelines of operators, DataFrame in and DataFrame out."""
