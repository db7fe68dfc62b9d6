"""Column expressions and filters shared by the reports."""
