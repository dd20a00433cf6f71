"""Smart-meter and distributed-energy analytics as plain PySpark DataFrame functions."""
