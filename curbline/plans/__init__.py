"""Jobs composed of operators: collection, the interval job, back-fill, and the query catalog."""
