"""tabmine.streaming."""
