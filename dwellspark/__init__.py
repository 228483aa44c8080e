"""Listing analytics on Spark: landed portal pages to listings, price histories and ranked leads."""
