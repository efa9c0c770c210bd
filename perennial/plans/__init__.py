"""Jobs and the catalogue of queries put together from the operators."""
