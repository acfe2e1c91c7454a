"""The registered queries, each over the driver's tables, with their SQL."""
