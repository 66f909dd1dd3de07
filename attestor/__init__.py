"""Entity evidence and corpus operators on Spark: claims, matching, roll-ups, change detection and audits as DataFrame jobs."""
