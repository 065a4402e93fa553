"""Column expressions shared by batch plans and streams."""
