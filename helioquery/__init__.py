"""helioquery: a PySpark-native engine for roof-level solar scoring and its spatial, raster and tract analytics."""

__version__ = "0.1.0"
