"""geoloom: Spark DataFrame operators for catalogued, georeferenced observation data."""

__version__ = "0.1.0"
