"""Change-event analytics as Spark jobs: ingest, merge, rollups, trends, bursts."""
