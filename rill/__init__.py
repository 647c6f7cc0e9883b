"""rill: analytics workloads (text, relational, similarity, sorting, keyed
tables, graphs, streams, recommendation) as Spark DataFrame plans."""

__version__ = "0.1.0"
