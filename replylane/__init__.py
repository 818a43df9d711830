"""Support-message triage as Spark DataFrame operations."""
