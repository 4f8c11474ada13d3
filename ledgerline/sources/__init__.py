"""Reading change messages and writing the logs."""
