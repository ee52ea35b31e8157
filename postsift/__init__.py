"""postsift: triage of social posts as Spark tables and streams."""

__version__ = "0.1.0"
