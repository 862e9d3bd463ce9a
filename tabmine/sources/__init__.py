"""tabmine.sources."""
