"""Web crawl archives to filtered, scored datasets, as Spark DataFrames."""
