"""News and social-engagement text analytics as Spark DataFrame jobs."""
