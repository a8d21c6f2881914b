"""storeloom: retail lakehouse analytics as lazy PySpark DataFrame functions."""
