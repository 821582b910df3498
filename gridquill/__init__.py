"""gridquill: table question answering and corpus preparation on Spark DataFrames."""
