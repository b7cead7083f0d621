"""tallyloom: market-data tables built as Spark DataFrame plans."""
