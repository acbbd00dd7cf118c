"""Labelled-image dataset analytics and training-data operators on Spark."""
