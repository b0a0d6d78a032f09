"""Reading source databases, landing snapshots, publishing daily partitions."""
