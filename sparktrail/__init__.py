"""sparktrail: e-commerce tracking analytics as PySpark DataFrame functions.

Every public function takes DataFrames (and plain parameters such as
``as_of``) and returns a DataFrame; nothing is collected to the driver.
"""

__version__ = "0.1.0"
