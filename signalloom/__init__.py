"""Company-level hiring signals from job postings, computed as Spark jobs."""
