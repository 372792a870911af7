"""Column expressions over reservation fields."""
