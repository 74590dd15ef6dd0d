"""The engine's plans."""
