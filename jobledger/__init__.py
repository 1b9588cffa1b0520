"""jobledger: Spark jobs over the records, logs and configuration that batch jobs leave behind."""
