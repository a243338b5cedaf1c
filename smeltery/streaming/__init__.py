"""Operators that need a stream: watermarks, event-time windows and keyed state."""
