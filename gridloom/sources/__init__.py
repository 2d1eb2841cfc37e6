"""Readers and writers. All of them run as file scans of Spark."""
