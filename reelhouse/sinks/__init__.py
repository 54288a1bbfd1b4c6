"""Writers: event topics, catalog tables, snapshots, databases."""
