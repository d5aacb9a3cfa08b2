"""featureflow: labelled image / feature-vector preparation and classification
on Spark DataFrames."""

__version__ = "0.1.0"
