"""epigrid: surveillance analytics (dense weekly series, rates, class breaks) on Spark."""

__version__ = "0.1.0"
