"""lakemart: raw ride-share feeds -> typed tables -> star schema -> reports, on Spark."""

__version__ = "0.1.0"
