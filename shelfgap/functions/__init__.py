"""Column builders: text parsing and repeatable arithmetic."""
