"""The queries users run, composed from the operators."""
