"""DataFrame -> DataFrame operators over order-line tables."""
