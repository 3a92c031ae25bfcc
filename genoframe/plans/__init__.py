"""Query catalogue: one Spark plan and one independent oracle SQL per operator."""
