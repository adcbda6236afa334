"""Reading and writing: feeds, snapshots, catalog tables."""
