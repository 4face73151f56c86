"""Column jobs: validation and standardisation."""
