"""Column functions over sequences and reads."""
