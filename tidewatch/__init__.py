"""Tidewatch: trends, sentiment and keyphrases over short social posts, as Spark jobs."""
