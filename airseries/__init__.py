"""Sensor time-series preparation, features and models as Spark DataFrame functions."""
