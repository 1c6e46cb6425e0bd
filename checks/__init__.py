"""Stand-in tables over the test data, the registered queries and their SQL twins."""
