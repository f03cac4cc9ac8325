"""Spark-native analytics over genomic interval, hit and read evidence."""
