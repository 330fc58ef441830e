"""Ready analyses over the reference's inputs (ratings, review text, commerce)."""
