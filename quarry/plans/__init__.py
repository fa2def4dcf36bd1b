"""Stand-in inputs derived from the driver tables and the catalog of registered queries."""
