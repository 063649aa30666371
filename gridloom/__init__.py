"""gridloom: gridded space-time preprocessing expressed as Spark DataFrame plans.

Fields are DataFrames in *cell form* ``(time, rlat, rlon, value)`` with the
grid's coordinates in a separate small frame ``(rlat, rlon, lat, lon)``;
samples are *tensor form* rows ``(key, time, ny, nx, tensor)``.
"""

__version__ = "0.1.0"
