"""Point-in-time rating, reconciliation and walk-forward evaluation over Spark DataFrames."""
