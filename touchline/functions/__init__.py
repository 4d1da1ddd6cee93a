"""Column functions: text, minutes, calendar and competition labels."""
