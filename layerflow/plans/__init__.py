"""Table plans: metadata specs, the three dimensions, audit and runs."""
