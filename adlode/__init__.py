"""adlode: listing analytics (extract, ingest, clean, tag, count, mine) as Spark jobs."""

__version__ = "0.1.0"
