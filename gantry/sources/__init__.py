"""Reading and writing: JSON landing files, published tables, shared scratch space."""
