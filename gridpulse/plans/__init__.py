"""Reports and partition jobs built from the operators."""
