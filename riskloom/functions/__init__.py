"""Column functions and interval arithmetic shared by the operators."""
