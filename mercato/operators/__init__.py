"""DataFrame -> DataFrame operators (no actions, no UDFs)."""
