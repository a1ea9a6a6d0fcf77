"""Structured Streaming forms of the event log, the ledger and receipt intake."""
