"""MLlib models over the curated table, and what is read off them."""
