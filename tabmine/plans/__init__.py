"""tabmine.plans."""
