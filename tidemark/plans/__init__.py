"""What to do, decided before any row is read: catalog, configuration, resolution, drift, target schema."""
