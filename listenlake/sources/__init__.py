"""Where events come from."""
