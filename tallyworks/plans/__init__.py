"""The three jobs, composed from the operators."""
