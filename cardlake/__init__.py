"""Batch analytics for payment-card data on Spark."""
