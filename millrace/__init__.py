"""Spark-native preparation, outlier labelling and model evaluation of observation tables."""

from millrace.roles import Roles

__all__ = ["Roles"]
