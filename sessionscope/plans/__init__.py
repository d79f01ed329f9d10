"""End-to-end plans: the session statistics job and the query registry."""
