"""Purchase-price analytics on Spark: landed pages -> typed records -> price marts."""
