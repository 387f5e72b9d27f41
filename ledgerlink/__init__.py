"""Link messy catalog tables, compare snapshots and build search links on Spark."""
