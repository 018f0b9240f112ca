"""Jobs that build the silver tables, and the catalogue of gold queries over them."""
