"""The engine's sources."""
