"""The ingest's per-match state machine, in batch and as a stream."""
