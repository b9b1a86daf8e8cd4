"""Readers and writers. Every reader has a fixed schema; none scans data to infer one."""
