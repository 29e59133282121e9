"""End-to-end stages composed from the operators."""
