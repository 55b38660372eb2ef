"""Jobs that wire the operators together, and the catalogue of business questions."""
