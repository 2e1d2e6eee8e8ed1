"""rosterloom."""
