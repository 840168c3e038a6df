"""Operators on whole tables: change capture, conversion with quarantine, upsert, the target store."""
