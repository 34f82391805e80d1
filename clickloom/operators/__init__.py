"""The batch jobs."""
