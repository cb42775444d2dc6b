"""Table schemas, the partitioned store, and landing-zone readers."""
