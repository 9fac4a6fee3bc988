"""Quayside: land, check, stage, sample, profile and model sales data on Spark."""
