"""Training-data operators: each module holds one operator, ``catalog`` the queries that apply them."""
