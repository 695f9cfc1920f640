"""Triggered Structured Streaming flows (bronze, silver with watermark dedup,
multi-flow quarantine) with checkpoints and observed rule counts."""
