"""carlot: vehicle-listing analytics as PySpark DataFrame operators.

Every operator takes and returns a DataFrame (usable with ``df.transform``);
every column function takes and returns a Column. Work stays in built-in
Spark SQL expressions; Python runs only inside Arrow steps: HTML extraction,
running sums over sorted partitions, NFKC and URL query edits.
"""

__version__ = "0.1.0"
