"""geoledger: change analysis over gridded scenes, polygons, boxes and run events as plain Spark DataFrames."""
