"""tallyframe: analytics over daily roster snapshots, written as Spark DataFrame operators."""
