"""Models and analyst queries composed from the operators."""
