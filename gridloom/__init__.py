"""Gridloom: a Spark-native engine that plans, checks and curates training corpora."""
