"""Jobs and ready-made queries composed from the operators."""
