"""tabmine.operators."""
