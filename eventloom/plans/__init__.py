"""Multi-step batch jobs built from the operators."""
