"""The engine's functions."""
