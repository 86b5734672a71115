"""Medallion pipeline and semantic layer for trucking-fleet data on Spark."""
