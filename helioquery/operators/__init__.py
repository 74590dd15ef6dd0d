"""The engine's operators."""
