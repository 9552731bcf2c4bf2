"""Applications built from the operators: the literacy products and the star-schema queries."""
