"""Structured Streaming: sinks, the stateful alert operator, job wiring."""
