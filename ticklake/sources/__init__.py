"""Readers: snapshots, tables, tick messages, mini-ticker payloads, the events table."""
