"""Reading and writing readings, payloads, locations and marts."""
