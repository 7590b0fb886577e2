"""Catalogue and raster analytics as Spark DataFrame jobs.

Pixels travel either as tile rows (one array per band) or as pixel rows
(``scene, x, y`` and one column per band).  Every function takes DataFrames
and returns a DataFrame; nothing runs before the caller asks for an action,
unless the function says otherwise.
"""

__version__ = "0.1.0"
