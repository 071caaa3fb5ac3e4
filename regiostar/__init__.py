"""Credit cohorts and regional indicators as a Spark star schema and yearly mart."""
