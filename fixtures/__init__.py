"""Card-shaped inputs derived from the test tables, and the queries over them."""
