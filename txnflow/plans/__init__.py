"""Models, reports, replay and operational metrics on top of the landing table."""
