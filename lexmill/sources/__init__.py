"""Readers of bibliographic exports, service payloads and manuscripts."""
