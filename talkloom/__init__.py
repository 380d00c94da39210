"""talkloom: dialogue dataset preparation and response evaluation as Spark jobs."""
