"""halfstar: rating analytics and recommendation as Spark DataFrame transformations."""

__version__ = "0.1.0"
