"""Riskloom: fraud analytics on transaction tables, written as Spark DataFrame jobs."""
