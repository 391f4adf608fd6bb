"""Video-platform analytics on Spark: detail tables, daily snapshots, summaries, live totals."""
