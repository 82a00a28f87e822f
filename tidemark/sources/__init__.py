"""Reading tables and landed files; publishing and appending results."""
