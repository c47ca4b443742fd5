"""Query plans: the analytical views and the profiling jobs."""
