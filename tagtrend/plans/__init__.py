"""Complete plans: the posting pipeline and the catalogue of checked queries."""
