"""Reading and writing delivery tables."""
