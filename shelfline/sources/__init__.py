"""Page snapshots, stored tables and exports."""
