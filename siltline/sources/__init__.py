"""Raw readers, landing, typed tables and JSON payloads."""
