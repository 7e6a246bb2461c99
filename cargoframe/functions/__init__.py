"""Pure Column functions (no Python UDFs)."""
