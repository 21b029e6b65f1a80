"""Analytics over dated snapshots of sold second-hand goods, built on Spark DataFrames."""
