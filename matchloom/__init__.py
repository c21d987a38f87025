"""matchloom: match analytics as Spark jobs, from raw JSON documents to checked analytic tables."""

__version__ = "0.1.0"
