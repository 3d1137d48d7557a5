"""The query catalogue: every entry pairs a Spark plan with its oracle SQL."""
