"""Receivables data operators and batch pipelines, written as Spark DataFrame plans."""
