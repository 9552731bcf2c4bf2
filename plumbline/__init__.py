"""plumbline: data quality, reconciliation and indicator products on Spark DataFrames."""
