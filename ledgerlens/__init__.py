"""Layered customer analytics on PySpark: cleaning, RFM, segmentation, scoring, reports, streams."""
