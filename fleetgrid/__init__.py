"""Ride-location analytics as Spark DataFrame operators."""
