"""Column functions and Arrow-backed functions on text and spans."""
