"""siltline: DataFrame operators for layered (bronze, silver, gold) tables on Spark."""
