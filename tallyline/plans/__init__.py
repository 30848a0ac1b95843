"""The reports: regulatory, engagement and amendment events."""
