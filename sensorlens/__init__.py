"""sensorlens: profile, prepare, model and explain wide sensor tables on Spark."""

__version__ = "0.1.0"
