"""canvass: survey analytics as composable PySpark DataFrame operators."""
