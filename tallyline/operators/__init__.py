"""DataFrame operations shared by the reports."""
