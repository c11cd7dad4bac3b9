"""End-to-end plans, the query registry, oracle SQL and the table builder."""
