"""A Spark-first engine for collections of papers and the texts behind them."""
