"""The append-only load and two window reports as streams."""
