"""Stock-movement counters and web metrics as Spark DataFrame operators."""
