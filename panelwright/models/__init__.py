"""Model fitting, combination and scoring."""
