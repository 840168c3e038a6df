"""Column-level functions: types, predicates, conversions, cursors, templates."""
