"""The engine's streaming."""
