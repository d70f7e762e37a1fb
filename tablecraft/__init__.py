"""tablecraft: DataFrame operators for metadata-driven table work on Spark."""
