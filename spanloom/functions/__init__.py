"""Column expressions over nested spans."""
