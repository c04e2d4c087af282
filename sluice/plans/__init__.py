"""Models, load jobs and proof queries built from the operators."""
