"""daytally: Spark jobs for daily device activity, orders and sale search."""
