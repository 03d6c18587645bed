"""Readers, raw contracts, the batch ledger and the raw sink."""
