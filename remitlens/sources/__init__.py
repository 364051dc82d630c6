"""Reading and writing tables, events and exports."""
