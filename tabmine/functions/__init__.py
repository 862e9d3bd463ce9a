"""tabmine.functions."""
