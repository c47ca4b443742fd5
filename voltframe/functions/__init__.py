"""Column-level helpers: name standardisation, predicates and casts."""
