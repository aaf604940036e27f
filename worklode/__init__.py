"""worklode: Spark DataFrame operators for job-posting and similar record feeds.

Every operator is a plain function from DataFrames (plus explicit parameters such as ``as_of``)
to DataFrames.  Nothing here collects rows to the driver or runs Python per row.
"""

__version__ = "0.1.0"
