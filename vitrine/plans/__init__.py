"""End-to-end recommendation plans composed from the operators."""
