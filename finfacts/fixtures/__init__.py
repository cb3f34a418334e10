"""Filing-shaped tables derived from the star-schema test data."""
