"""The engine's operators, one module per family."""
