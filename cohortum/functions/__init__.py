"""Column functions: every one takes and returns a Column, none needs a Python worker."""
