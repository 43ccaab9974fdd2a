"""Marketplace analytics on Spark: landed feeds in, facts and daily reports out."""
