"""Query plans: named queries over the driver tables and their SQL oracles."""
