"""Jobs that compose operators and write the layers."""
