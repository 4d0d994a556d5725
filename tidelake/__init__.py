"""Rental analytics and a daily bronze/silver/gold lakehouse as Spark jobs."""
